"""Tick stream checks (T1-T4, A9, F20): a file stream over the events table
runs to completion (availableNow) and must equal the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.streaming import ticks
from sluice.suite import case
from sluice.suite.common import t

SYMBOLS = ["click", "view", "purchase"]
SYMBOLS_SQL = "('click', 'view', 'purchase')"


def tick_stream(spark, sf_dir):
    schema = t(spark, sf_dir, "events").schema
    s = ticks.read_ticks(spark, sf_dir, schema, symbols=SYMBOLS, symbol_col="event_type",
                         file_glob="events.parquet")
    return s.select(F.col("event_type").alias("id"),
                    F.when(F.col("value") >= 10, F.col("value")).alias("price"),
                    (F.col("value") * 2).alias("regularMarketPrice"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"))


@case("tick_projection", f"""
SELECT event_type AS id, CASE WHEN value >= 10 THEN value ELSE value * 2 END AS price,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events WHERE event_type IN {SYMBOLS_SQL}""")
def tick_projection(spark, sf_dir):
    root = scratch_path(spark, "ticks")
    projected = ticks.project_ticks(tick_stream(spark, sf_dir))
    q = ticks.collect_to(projected, f"{root}/out", f"{root}/checkpoint")
    ticks.run_for(q)
    return spark.read.parquet(f"{root}/out")


@case("tick_count", f"SELECT count(*) AS message_count FROM events WHERE event_type IN {SYMBOLS_SQL}")
def tick_count(spark, sf_dir):
    root = scratch_path(spark, "tick_count")
    q = ticks.count_to(tick_stream(spark, sf_dir), f"{root}/out", f"{root}/checkpoint")
    ticks.run_for(q)
    return spark.read.parquet(f"{root}/out")


@case("tick_live", f"""
SELECT event_type AS id, CASE WHEN value >= 10 THEN value ELSE value * 2 END AS price,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events WHERE event_type IN {SYMBOLS_SQL}""")
def tick_live(spark, sf_dir):
    """T4: a live run over landed tick files, a file in each trigger, ended by
    the clock, and started again until no file is left: each message once."""
    root = scratch_path(spark, "tick_live")
    events = t(spark, sf_dir, "events")
    events.repartition(6).write.parquet(f"{root}/landing")
    schema = events.schema

    def start():
        ticks_in = ticks.read_ticks(spark, f"{root}/landing", schema, symbols=SYMBOLS, symbol_col="event_type",
                                    max_files_per_trigger=1)
        projected = ticks.project_ticks(ticks_in.select(
            F.col("event_type").alias("id"), F.when(F.col("value") >= 10, F.col("value")).alias("price"),
            (F.col("value") * 2).alias("regularMarketPrice"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time")))
        return projected.schema, ticks.live_to(projected, f"{root}/out", f"{root}/checkpoint", "200 milliseconds")

    out_schema, query = start()
    ticks.run_for(query, 1.5)                   # ended wherever it is
    _, query = start()
    query.processAllAvailable()
    query.stop()
    return ticks.live_messages(spark, f"{root}/out", out_schema)
