"""Predicates and record helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.scalars import col_of

__all__ = ["contains_ci", "any_distinct", "pick", "fill_from", "find_col",
           "require", "where_in", "between", "optional_eq"]


# P6
def contains_ci(c, text: str) -> Column:
    """Case-insensitive substring test; null counts as false."""
    return F.coalesce(F.lower(col_of(c)).contains(text.lower()), F.lit(False))


# P7
def any_distinct(left: str, right: str, cols) -> Column:
    """True when any compared column differs (null-safe) between two aliases."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, tests)


# P8
def pick(map_col, keys, prefix: str = "") -> list[Column]:
    """Fixed field subset from a map column; absent keys become null."""
    m = col_of(map_col)
    return [F.try_element_at(m, F.lit(k)).alias(prefix + k) for k in keys]


# P17
def fill_from(c, fallback) -> Column:
    """Missing value filled from the parent (a Column) or a default literal."""
    return F.coalesce(col_of(c), fallback if isinstance(fallback, Column) else F.lit(fallback))


# P13
def find_col(df, fragments, exclude=()) -> str | None:
    """First column of a frame (or of a list of names), in their order, whose
    lower-cased name contains any of the fragments."""
    for name in df.columns if isinstance(df, DataFrame) else df:
        if name not in exclude and any(frag in name.lower() for frag in fragments):
            return name
    return None


# P3
def require(df: DataFrame, cols) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


# P4
def where_in(df: DataFrame, col: str, ids) -> DataFrame:
    """Membership filter: a list (configuration) is an IN set that reaches the
    scan, a one-column DataFrame a left-semi join."""
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).alias(col)).distinct(), on=col, how="left_semi")
    return df.where(F.col(col).isin(list(ids)))


# P12
def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    c = F.col(col)
    if lo is not None:
        df = df.where(c >= F.lit(lo))
    if hi is not None:
        df = df.where(c <= F.lit(hi))
    return df


# P9
def optional_eq(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """Case-insensitive equality filter, skipped when no value is given."""
    if value is None or str(value).strip() == "":
        return df
    return df.where(F.lower(F.col(col)) == str(value).strip().lower())
