"""Sorting, top-k, sampling, stacking, screening and ranking (O1-O7, W3, W4,
U1-U4, P14, P15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalars import col_of, month_text_date
from sluice.session import materialize


# O1
def sort_if_present(df: DataFrame, cols) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in present]) if present else df


# O2
def order_by_month(df: DataFrame, month_text: str) -> DataFrame:
    return df.orderBy(month_text_date(month_text).asc_nulls_last())


def _sort(field: str, asc: bool) -> Column:
    return F.col(field).asc_nulls_last() if asc else F.col(field).desc_nulls_last()


# O3 / O5
def top_k(df: DataFrame, field: str, asc: bool, k: int, tiebreak=()) -> DataFrame:
    """First ``k`` rows by one field (TakeOrderedAndProject: per-task top-k
    then a k-way merge, never a full sort)."""
    order = [_sort(field, asc)] + [F.col(c).asc_nulls_last() for c in tiebreak]
    return df.orderBy(*order).limit(k)


# O4
def tail_by(df: DataFrame, date: str, n: int, tiebreak=()) -> DataFrame:
    """Last ``n`` rows by date, returned in ascending order."""
    last = df.orderBy(F.col(date).desc_nulls_first(),
                      *[F.col(c).desc_nulls_first() for c in tiebreak]).limit(n)
    return last.orderBy(F.col(date).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak])


# P12
def last_days(df: DataFrame, date: str, n: int, by=()) -> DataFrame:
    """Rows of the last ``n`` dates that occur (for each ``by``): the calendar
    of distinct dates, ranked, cut to its last n, and joined back. Gaps don't
    count as days, and every row of a day stays."""
    by = [by] if isinstance(by, str) else list(by)
    calendar = df.where(F.col(date).isNotNull()).select(*by, date).distinct()
    if by:
        calendar = top_n_per_group(calendar, by, [F.col(date).desc()], n)
    else:
        calendar = calendar.orderBy(F.col(date).desc()).limit(n)
    same = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*by, date]])
    return df.alias("d").join(calendar.alias("c"), same, "left_semi")


def in_period(df: DataFrame, date: str, period: str) -> DataFrame:
    """Rows in a period such as ``5d`` (dates that occur), ``1mo``, ``2y`` (back
    from the last date, which a scalar subquery reads), ``ytd`` or ``max``."""
    import re
    last = df.agg(F.max(date)).scalar()
    if period == "max":
        return df
    if period == "ytd":
        return df.where(F.col(date) >= F.trunc(last, "year"))
    found = re.fullmatch(r"([1-9]\d*)(d|mo|y)", period)
    if not found:
        raise ValueError(f"unknown period {period!r}")
    n, unit = int(found[1]), found[2]
    if unit == "d":
        return last_days(df, date, n)
    return df.where(F.col(date) > F.add_months(last, -n * (12 if unit == "y" else 1)))


# O6 / F25
def random_sample(df: DataFrame, n: int = 1_000, seed: int = 42, key=None) -> DataFrame:
    """``n`` random rows (all rows when there are fewer): those with the least
    hashes of seed and key (all columns, if no key is given).

    One pass, a top-n in every task and a merge of those; the rows are the same
    for every partitioning, so a lost task draws them again. Rows with equal
    keys are told apart by their other columns, in ascending order."""
    if key is None:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if df.columns else F.lit("")
    else:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), text).cast("binary"))
    rest = [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields if _ordered(f.dataType)]
    return df.orderBy(drawn, *rest).limit(n)


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


# W3
def top_n_per_group(df: DataFrame, by, order, n: int, rank_name: str | None = None) -> DataFrame:
    """Top ``n`` rows per group (partial WindowGroupLimit before the shuffle)."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*[col_of(o) for o in order])
    rn = rank_name or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_name else out.drop(rn)


# W4
def assign_ids(new: DataFrame, key, current_max: int | Column = 0, id_name: str = "id") -> DataFrame:
    """Consecutive surrogate ids ``current_max + 1 ..`` in key order.

    Distributed rank: range-partition and sort by key, count rows per
    partition (one row per partition), turn counts into start offsets on that
    tiny table, and add each row's position inside its partition. No step
    moves all rows into one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # A per-row tiebreak lets the range partitioner split a mass of equal
    # keys (or identical copies) over several partitions.
    order = [F.col(k).asc_nulls_last() for k in keys] + [F.col("__tb").asc()]
    spark = new.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (new.withColumn("__tb", F.monotonically_increasing_id())
              .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__tb"))
    ranged = ranged.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__mid", F.monotonically_increasing_id())
    ranged = materialize(ranged)  # reliable checkpoint: ids must not be recomputed
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                         F.min("__mid").alias("__first"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    base = current_max if isinstance(current_max, Column) else F.lit(current_max)
    # One row per partition: the broadcast is bounded by the partition count.
    j = ranged.join(F.broadcast(offsets.select("__pid", "__off", "__first")), "__pid")
    idc = (base + F.col("__off") + (F.col("__mid") - F.col("__first")) + 1).cast("long")
    return j.withColumn(id_name, idc).drop("__pid", "__mid", "__off", "__first")


# U1 / U2
def stack(dfs, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(dfs))


# U3
def tagged_stack(frames: dict, tag_col: str = "source") -> DataFrame:
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()]
    return stack(tagged, allow_missing=True)


# U4
def unify_levels(levels: dict, level_col: str = "geography_level",
                 value_col: str = "geography_value") -> DataFrame:
    """Stack per-level frames that each hold a ``value_col`` into one fact."""
    return stack([df.withColumn(level_col, F.lit(lvl)) for lvl, df in levels.items()],
                 allow_missing=True)


# Screener predicate tree.
_CMP = {"gt": "__gt__", "lt": "__lt__", "gte": "__ge__", "lte": "__le__"}


def predicate(tree) -> Column:
    """Fold ``("and"|"or", [..])``, ``("eq", f, v)``, ``("is-in", f, [..])``,
    ``("btwn", f, lo, hi)``, ``("gt"|"lt"|"gte"|"lte", f, v)`` to one Column."""
    op = tree[0].lower()
    if op in ("and", "or"):
        parts = [predicate(t) for t in tree[1]]
        return reduce((lambda a, b: a & b) if op == "and" else (lambda a, b: a | b), parts)
    field = F.col(tree[1])
    if op == "eq":
        return field == F.lit(tree[2])
    if op == "is-in":
        return field.isin(list(tree[2]))
    if op == "btwn":
        return field.between(F.lit(tree[2]), F.lit(tree[3]))
    if op in _CMP:
        return getattr(field, _CMP[op])(F.lit(tree[2]))
    raise ValueError(f"unknown screen operator {op}")


def screen(df: DataFrame, tree, size: int, sort_field: str, sort_asc: bool = False,
           tiebreak=()) -> DataFrame:
    """Filter by the tree (pushed into the scan), then top ``size``."""
    return top_k(df.where(predicate(tree)), sort_field, sort_asc, size, tiebreak)


# Named presets over a quote table with columns
# (sector, exchange, pe, market_cap, price, change_pct, volume).
PRESETS = {
    "most_actives": (("gt", "volume", 0), "volume", False),
    "day_gainers": (("gt", "change_pct", 3.0), "change_pct", False),
    "day_losers": (("lt", "change_pct", -2.5), "change_pct", True),
    "undervalued_large_caps": (("and", [("btwn", "pe", 0, 20), ("gte", "market_cap", 1500.0)]),
                               "market_cap", False),
    "growth_technology_stocks": (("and", [("is-in", "sector", ["technology"]), ("gt", "change_pct", 0.0)]),
                          "change_pct", False),
}


def screen_preset(df: DataFrame, name: str, size: int = 25, tiebreak=()) -> DataFrame:
    tree, field, asc = PRESETS[name]
    return screen(df, tree, size, field, asc, tiebreak)
