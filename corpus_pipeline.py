"""A corpus pipeline over ``documents``: quality rules, near-duplicate removal,
substring removal, secret redaction, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
it kept; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import near_duplicates, packing, repetition, secret_scan, substrings
from sluice.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the repetition rule keep."""
    return repetition.keep_unrepetitive(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the least doc_id."""
    return near_duplicates.keep_one(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of later repeats of 20 words or more."""
    return substrings.drop_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in a training sequence."""
    return packing.packed(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("substring", substring),
    ("secrets", secrets),
    ("pack", pack),
]

# The stages are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
