"""Shared fixtures of the registered checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import read_table

# Fixed run timestamp of every registered check (never current_timestamp()).
RUN_TS = "2024-02-01 00:00:00"
RUN_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
OLD_TS = "2020-01-01 00:00:00"
OLD_SQL = "TIMESTAMP '2020-01-01 00:00:00'"
# Merge fixture: previous snapshot cut and current extract start.
TARGET_CUT = "2024-01-20 12:00:00"
SOURCE_FROM = "2024-01-15 00:00:00"


_TABLES: dict = {}


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Base table reader; the DataFrame (file listing, footer schema) is
    reused within a session since the test tables are read-only."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = read_table(spark, sf_dir, name)
    return df


def dec_sum(col: str):
    """Exact sum of a 2-decimal double (cast back to double), so both engines
    agree to the last bit."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def dec_sum_sql(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"
