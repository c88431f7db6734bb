"""Tick stream: subscribe, project, count, run for a bounded time.

In production the source is a message bus; here and in tests it is a file
stream over landed tick files, with the same downstream plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.scalars import falsy_or


# T1
def read_ticks(spark: SparkSession, folder: str, schema, symbols=None,
               symbol_col: str = "id", file_glob: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(folder)
    if symbols:
        df = df.where(F.col(symbol_col).isin(list(symbols)))
    return df


# T2
def project_ticks(df: DataFrame, id_col: str = "id", price: str = "price",
                  fallback_price: str = "regularMarketPrice", time_col: str = "time") -> DataFrame:
    """id defaults to ``?``, price falls back when 0/missing, time to empty."""
    return df.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("?")).alias("id"),
        falsy_or(price, fallback_price).alias("price"),
        F.coalesce(F.col(time_col).cast("string"), F.lit("")).alias("time"))


# T4
def run_for(query: StreamingQuery, seconds: float | None = None) -> StreamingQuery:
    """Bounded run: wait for the trigger to finish (availableNow) or for
    ``seconds`` (live), then stop cleanly."""
    if seconds is None:
        query.awaitTermination()
    else:
        query.awaitTermination(seconds)
        query.stop()
    return query


def collect_to(df: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append every projected message to a parquet folder (exactly-once with
    the checkpoint)."""
    w = df.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


# T3 / A9
def count_to(df: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Running total message count (complete mode); each micro-batch
    overwrites one-row parquet output."""
    counts = df.groupBy().agg(F.count(F.lit(1)).alias("message_count"))

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    w = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.foreachBatch(write).start()


# T4: a live run. Each micro-batch has its own folder, which a batch that is run again
# after a crash overwrites, and an entry in a ledger, written after it: a message
# counts once, however often and wherever a run is ended.
def live_to(df: DataFrame, out: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Write every message to ``out`` on a processing-time trigger."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={number}")
        entry = batch.sparkSession.range(1).select(F.lit(number).cast("long").alias("number"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/entry={number}")

    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).foreachBatch(write).start())


def live_messages(spark: SparkSession, out: str, schema) -> DataFrame:
    """The messages of all batches in the ledger."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    done = spark.read.schema("number BIGINT").parquet(f"{out}/ledger").select(F.col("number").alias("batch"))
    return spark.read.schema(whole).parquet(f"{out}/data").join(done, "batch", "left_semi").select(*schema.names)
