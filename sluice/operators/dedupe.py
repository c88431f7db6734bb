"""Latest-wins and first-occurrence deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalars import col_of


def _order_cols(order) -> list[Column]:
    return [col_of(o) for o in order]


def latest_wins(df: DataFrame, keys, order, tiebreak="rest") -> DataFrame:
    """Keep one row per key: the first under ``order``.

    ``order`` is a list of sort columns such as
    ``F.col("extracted_at").desc_nulls_last()``. With ``tiebreak="rest"`` the
    greatest ``source_file`` wins (where there is such a column), then the
    remaining columns that can be ordered are appended in descending order, so
    the choice is deterministic even when every order column ties.

    The filter ``row_number() == 1`` is planned by Catalyst as a partial
    WindowGroupLimit before the shuffle and a final one after it, so a hot key
    is reduced to one row per map task before it crosses the network.
    """
    keys = list(keys)
    order = _order_cols(order)
    if tiebreak == "rest":
        rest = [f.name for f in df.schema.fields if f.name not in keys
                and not isinstance(f.dataType, (T.MapType, T.VariantType))]
        rest.sort(key=lambda c: c != "source_file")         # stable: the others keep their order
        order = order + [F.col(c).desc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def dedupe_ordered(df: DataFrame, key: str, pos_cols) -> DataFrame:
    """First occurrence of each key by position (order-preserving dedupe)."""
    return latest_wins(df, [key], [F.col(c).asc() for c in pos_cols], tiebreak=None)


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column (partial + final aggregate)."""
    return df.where(F.col(col).isNotNull()).select(col).distinct()


def duplicate_keys(df: DataFrame, keys, count_name: str = "n") -> DataFrame:
    """Keys that occur more than once (merge-source precondition, V7)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """Raise if ``df`` repeats a key; return ``df`` unchanged otherwise.

    The check is a partial + final hash aggregate (skew-safe: a hot key is
    pre-counted in every map task) stopped at the first duplicate.
    """
    dup = duplicate_keys(df, keys).limit(1)
    if dup.count() > 0:
        raise ValueError(f"source is not unique on {list(keys)}: {dup.first()}")
    return df
