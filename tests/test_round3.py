"""Samples, periods, listings and live runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators.explore import in_period, last_days, random_sample
from sluice.session import scratch_path
from sluice.sources.landing import list_tables
from sluice.streaming import ticks


def test_sample_is_the_same_for_every_partitioning(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    for key in (None, ["id"], ["k"]):
        one = {r.id for r in random_sample(df.coalesce(1), 50, 3, key).collect()}
        assert one == {r.id for r in random_sample(df.repartition(17), 50, 3, key).collect()} and len(one) == 50
    assert one != {r.id for r in random_sample(df, 50, 4, ["id"]).collect()}
    assert random_sample(df, 9999, 1).count() == 5000 and random_sample(df.limit(0), 5).count() == 0
    plan = random_sample(df, 50, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_last_days_with_gaps_ties_and_nulls(spark):
    d = lambda s: dt.date.fromisoformat(s) if s else None
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-05", 2), ("a", "2024-01-05", 3), ("a", "2024-03-01", 4), ("b", "2024-01-05", 5),
            ("b", "2023-01-01", 6), (None, "2024-01-01", 7), ("a", None, 8)]
    df = spark.createDataFrame([(s, d(x), v) for s, x, v in rows], "s STRING, day DATE, v INT")
    got = lambda out: sorted(r.v for r in out.collect())
    assert got(last_days(df, "day", 2)) == [2, 3, 4, 5]
    assert got(last_days(df, "day", 2, "s")) == [2, 3, 4, 5, 6, 7]
    assert got(in_period(df, "day", "1d")) == [4] and got(in_period(df, "day", "2mo")) == [2, 3, 4, 5]
    assert got(in_period(df, "day", "1y")) == [1, 2, 3, 4, 5, 7] and got(in_period(df, "day", "ytd")) == [1, 2, 3, 4, 5, 7]
    assert len(got(in_period(df, "day", "max"))) == 8
    with pytest.raises(ValueError):
        in_period(df, "day", "0d")


def test_listing_counts_in_one_job_from_footers(spark, tmp_path):
    for i in range(3):
        spark.range(10 * i).write.parquet(f"{tmp_path}/t{i}")
        spark.read.parquet(f"{tmp_path}/t{i}").createOrReplaceTempView(f"t_count_{i}")
    out = list_tables(spark, with_counts=True, pattern="t_count_*")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("ReadSchema: struct<>") == 3
    assert [(r.table_name, r.row_count) for r in out.collect()] == [("t_count_0", 0), ("t_count_1", 10), ("t_count_2", 20)]
    for i in range(3):
        spark.catalog.dropTempView(f"t_count_{i}")


def test_a_batch_that_is_run_again_counts_once(spark, monkeypatch):
    root = scratch_path(spark, "t_live")
    spark.range(0, 40, 1, 4).select(F.col("id").cast("string").alias("id")).write.parquet(f"{root}/in")

    def start():
        df = ticks.read_ticks(spark, f"{root}/in", "id STRING", max_files_per_trigger=1)
        return ticks.live_to(df, f"{root}/out", f"{root}/checkpoint", "100 milliseconds")

    # What a batch leaves behind whose driver is lost before its ledger entry.
    spark.range(3).select(F.lit("half").alias("id")).write.parquet(f"{root}/out/data/batch=0")
    spark.createDataFrame([], "number BIGINT").write.parquet(f"{root}/out/ledger/entry=none")
    schema = spark.read.parquet(f"{root}/in").schema
    assert ticks.live_messages(spark, f"{root}/out", schema).count() == 0
    query = start()
    ticks.run_for(query, 0.5)
    query = start()
    query.processAllAvailable()
    query.stop()
    got = sorted(int(r.id) for r in ticks.live_messages(spark, f"{root}/out", schema).collect())
    assert got == list(range(40))
