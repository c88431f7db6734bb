"""Loads of landed files with a reject store and a result for each file.

A load reads its files once and writes the rows and the rejected records side
by side, as partitions of one folder. Rows count only from the commit on: an
entry in the table of loads, written last. So a load that fails, or that is
given up at its first bad record (``on_error="abort"``), leaves the table as it
was, and the same load id given again replaces what a dead run left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.landing import csv_lines, typed

CORRUPT = "__corrupt"
REJECT = "__reject"
COMMITS_DDL = "load_id STRING, on_error STRING"
# A comma outside quotes: an even number of quotes follows up to the end.
FIELD_END = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _folder(root: str, load_id: str) -> str:
    return f"{root}/data/load_id={load_id}"


def load_csv(spark: SparkSession, path: str, columns, root: str, load_id: str, *, on_error: str = "continue",
             pattern: str | None = None, recursive: bool = True, multi_line: bool = True) -> DataFrame:
    """Load the CSV files at ``path`` into the raw table at ``root`` (texts by
    position, with ``source_file``) and return the result for each file. A
    record with another number of fields is a reject: kept with its text and
    the reason, or with ``on_error="abort"`` the end of the load."""
    if on_error not in ("continue", "abort"):
        raise ValueError("on_error must be 'continue' or 'abort'")
    corrupt = CORRUPT if on_error == "continue" else None
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *([corrupt] if corrupt else [])]])
    rows = (csv_lines(spark, fields, pattern, recursive, on_error, multi_line, corrupt).csv(path)
            .withColumn("source_file", F.col("_metadata.file_path")))
    if not corrupt:
        rows = rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    found = F.size(F.split(CORRUPT, FIELD_END))
    why = F.concat(F.lit(f"expected {len(columns)} fields, found "), found.cast("string"))
    rows = rows.withColumn(REJECT, F.col(CORRUPT).isNotNull()).withColumn("error", F.when(F.col(REJECT), why))
    (rows.select(*columns, "source_file", F.col(CORRUPT).alias("record"), "error", REJECT)
     .write.mode("overwrite").partitionBy(REJECT).parquet(_folder(root, load_id)))
    results = file_results(spark, path, _staged(spark, root, columns).where(F.col("load_id") == load_id), pattern, recursive)
    results.write.mode("overwrite").parquet(f"{root}/files/load_id={load_id}")
    spark.createDataFrame([(load_id, on_error)], COMMITS_DDL).write.mode("append").parquet(f"{root}/commits")
    return load_results(spark, root).where(F.col("load_id") == load_id)


def file_results(spark: SparkSession, path: str, staged: DataFrame, pattern: str | None, recursive: bool) -> DataFrame:
    """A row for each file that has a byte, those without a record included: records parsed,
    loaded and rejected, the first reason (by the text of the record, since the
    order of lines is not kept) and a status."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        files = files.option("pathGlobFilter", pattern)
    # No content column: the files are listed, not read.
    files = files.load(path).select(F.col("_metadata.file_path").alias("source_file"))
    counts = staged.groupBy("source_file").agg(
        F.count("*").alias("rows_parsed"), F.count_if(REJECT).alias("rows_rejected"),
        F.min(F.when(F.col(REJECT), F.struct("record", "error")))["error"].alias("first_error"))
    rejected, parsed = F.coalesce("rows_rejected", F.lit(0)), F.coalesce("rows_parsed", F.lit(0))
    status = (F.when(rejected == 0, "loaded").when(rejected == parsed, "load_failed").otherwise("partially_loaded"))
    return files.join(counts, "source_file", "left").select(
        "source_file", status.alias("status"), parsed.alias("rows_parsed"), (parsed - rejected).alias("rows_loaded"),
        rejected.alias("rows_rejected"), "first_error")


def _committed(spark: SparkSession, root: str, df: DataFrame) -> DataFrame:
    commits = spark.read.schema(COMMITS_DDL).parquet(f"{root}/commits").select("load_id").distinct()
    return df.join(commits, "load_id", "left_semi")


def _staged(spark: SparkSession, root: str, columns) -> DataFrame:
    texts = ", ".join(f"`{c}` STRING" for c in [*columns, "source_file", "record", "error"])
    return spark.read.schema(f"{texts}, load_id STRING, {REJECT} BOOLEAN").parquet(f"{root}/data")


def loaded_rows(spark: SparkSession, root: str, columns, types: dict | None = None) -> DataFrame:
    """The rows of all committed loads, each column cast as in ``scan_csv``."""
    rows = _committed(spark, root, _staged(spark, root, columns).where(~F.col(REJECT)))
    return rows.select(*typed([*columns], types), "source_file", "load_id")


def rejects(spark: SparkSession, root: str, columns) -> DataFrame:
    """The records that committed loads rejected, with the reason."""
    rows = _committed(spark, root, _staged(spark, root, columns).where(F.col(REJECT)))
    return rows.select("load_id", "source_file", "record", "error")


def load_results(spark: SparkSession, root: str) -> DataFrame:
    """The result for each file of all committed loads."""
    ddl = ("source_file STRING, status STRING, rows_parsed BIGINT, rows_loaded BIGINT, rows_rejected BIGINT, "
           "first_error STRING, load_id STRING")
    return _committed(spark, root, spark.read.schema(ddl).parquet(f"{root}/files"))
