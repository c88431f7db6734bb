"""Grouped aggregates used for verification and book-keeping.

All of them are hash aggregates with a partial (map-side) step, so a hot
group is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, by, name: str = "row_count") -> DataFrame:
    """A1: rows per group, ordered by group."""
    by = [by] if isinstance(by, str) else list(by)
    return (df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
            .orderBy(*[F.col(c).asc_nulls_last() for c in by]))


def coverage(df: DataFrame, by, date: str, distinct: str | None = None,
             names: dict | None = None) -> DataFrame:
    """A2/A3: count, first and last date per group (+ distinct count)."""
    by = [by] if isinstance(by, str) else list(by)
    n = {"rows": "total_rows", "first": "earliest", "last": "latest",
         "distinct": "distinct_count"}
    n.update(names or {})
    aggs = []
    if distinct:
        aggs.append(F.count_distinct(F.col(distinct)).alias(n["distinct"]))
    aggs += [F.min(date).alias(n["first"]), F.max(date).alias(n["last"]),
             F.count(F.lit(1)).alias(n["rows"])]
    return (df.groupBy(*by).agg(*aggs)
            .orderBy(*[F.col(c).asc_nulls_last() for c in by]))


def annual_total(df: DataFrame, by, date: str, value: str,
                 year_name: str = "data_year", total_name: str = "value",
                 year=None) -> DataFrame:
    """A4: monthly to annual sums; null months skipped, empty years absent.

    ``year`` overrides the year expression (e.g. taken from month text).
    """
    by = [by] if isinstance(by, str) else list(by)
    y = F.year(date) if year is None else year
    return (df.where(F.col(value).isNotNull() & F.col(date).isNotNull())
            .groupBy(*by, y.alias(year_name))
            .agg(F.sum(value).alias(total_name)))


def grain_totals(df: DataFrame, grains: dict, sums: dict, level_name: str = "level") -> DataFrame:
    """Sums at several grains over one scan (U4, R3). ``grains``: level ->
    grouping columns (a different set for each level); ``sums``: name -> column
    to add up. Rows are added up at the finest grain first, and GROUPING SETS
    expand only those. A column that a level does not group by is null."""
    cols = list(dict.fromkeys(c for own in grains.values() for c in own))
    if len({frozenset(own) for own in grains.values()}) < len(grains):
        raise ValueError("two levels have the same columns")
    finest = df.groupBy(*cols).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    # grouping_id: a bit for each column, the first one highest, set where it is left out.
    level = F.lit(None).cast("string")
    for name, own in grains.items():
        left_out = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in own)
        level = F.when(F.col("__id") == left_out, name).otherwise(level)
    totals = finest.groupingSets([list(own) for own in grains.values()], *cols).agg(
        F.grouping_id().alias("__id"), *[F.sum(n).alias(n) for n in sums])
    return totals.select(level.alias(level_name), *cols, *sums)


def delta_stats(delta: DataFrame, key: str, date: str) -> DataFrame:
    """Per-series row count and last date of a delta."""
    return delta.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"),
                                  F.max(date).alias("end_date"))


def run_totals(log: DataFrame, status: str = "status", rows: str = "record_count") -> DataFrame:
    """Totals of one extraction run in a single pass (names as in the
    run summary record)."""
    return log.agg(
        F.count(F.lit(1)).alias("total_series"),
        F.count_if(F.col(status) == "success").alias("successful_series"),
        F.count_if(F.col(status) == "error").alias("failed_series"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("rows_uploaded"),
    )
