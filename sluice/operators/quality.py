"""Key and column quality checks (V7-V10); one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.dedupe import duplicate_keys  # noqa: F401  (V7)


def null_counts(df: DataFrame, cols) -> DataFrame:
    """V8: one row, nulls per NOT NULL column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def overlong(df: DataFrame, limits: dict) -> DataFrame:
    """V9: one row, values longer than the declared length per column."""
    return df.agg(*[F.count_if(F.length(F.col(c)) > n).alias(f"{c}_overlong")
                    for c, n in limits.items()])


def missing_members(grid: DataFrame, delivered: DataFrame, keys) -> DataFrame:
    """Requested members with no delivered row."""
    return grid.join(delivered.select(*keys).distinct(), on=list(keys), how="left_anti")


def assert_not_empty(df: DataFrame, what: str = "extraction") -> DataFrame:
    """Fail the run when nothing was collected (one early-stopping job)."""
    if df.isEmpty():
        raise RuntimeError(f"{what} returned no rows")
    return df
