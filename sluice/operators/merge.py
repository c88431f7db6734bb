"""Keyed upsert of a curated snapshot.

Parquet tables have no row-level MERGE, so a merge produces the next
snapshot: one full outer join of target and (deduplicated) source on the key.
Rows whose key holds a null never match (SQL equality). So that a mass of
such rows (or of identical copies of one) does not land in a single shuffle
partition, every row carries a spread value that is 0 for complete keys and
a side-signed row id for incomplete ones; it is part of the join key, so it
never creates a match, it only spreads the unmatched rows. When neither side
can hold a null key (declared NOT NULL keys), ``spread_nulls=False`` joins on
the key alone, and a hash partitioning on the key that both inputs already
have (e.g. from ``latest_wins``) is reused without another exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.predicates import any_distinct

T_FLAG, S_FLAG, SPREAD = "__in_t", "__in_s", "__spread"


def _null_key(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _spread(df: DataFrame, keys, sign: int, on: bool = True) -> DataFrame:
    if not on:
        return df
    # Any value works for correctness (a null key never matches); a per-row id
    # spreads even identical copies, and works for every column type. The
    # "complete key" value is a zero the optimizer cannot fold: if it folded
    # (one side's keys provably non-null) the spread would drop out of the
    # join keys and the other side's null keys would meet in one partition.
    h = F.monotonically_increasing_id() + 1
    zero = F.spark_partition_id() * 0
    return df.withColumn(SPREAD, F.when(_null_key(keys), h * sign).otherwise(zero).cast("long"))


def _key_cond(keys, spread: bool = True) -> list[Column]:
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return cond + [F.col(f"t.{SPREAD}") == F.col(f"s.{SPREAD}")] if spread else cond


def _insert_exprs(target: DataFrame, source: DataFrame, set_insert) -> dict:
    """Insert expression per target column: explicit, else the source column
    of that name, else a typed null (an omitted column in INSERT)."""
    out = {}
    types = dict(target.dtypes)
    for c in target.columns:
        if c in set_insert:
            out[c] = set_insert[c]
        elif c in source.columns:
            out[c] = F.col(f"s.{c}")
        else:
            out[c] = F.lit(None).cast(types[c])
    return out


def merge(target: DataFrame, source: DataFrame, keys, *,
          set_update: dict | None = None,
          set_insert: dict | None = None,
          update_when=None,
          null_keys: str = "insert",
          spread_nulls: bool = True) -> DataFrame:
    """Return the target snapshot after ``MERGE source INTO target``.

    * ``set_update``: column -> expression over aliases ``t`` and ``s`` for
      matched rows; columns not named keep the target value. ``None`` makes
      an insert-only merge (J3).
    * ``set_insert``: column -> expression over alias ``s`` for new rows;
      other target columns are copied from the source column of that name.
    * ``update_when``: list of columns; matched rows are only updated when
      one of them differs null-safely (J2). ``None`` updates every match.
    * ``null_keys``: ``"insert"`` (null-keyed source rows are inserted, as
      SQL MERGE does) or ``"drop"``.
    * ``spread_nulls``: add the spread join key (see module doc). Pass False
      when neither side can hold a null key (declared NOT NULL keys and
      ``null_keys="drop"``): the join then reuses a hash partitioning on the
      key that the inputs already have (e.g. from ``latest_wins``).

    The source must be unique on ``keys`` (see ``latest_wins``).
    """
    keys = list(keys)
    cols = target.columns
    set_insert = set_insert or {}
    ins = _insert_exprs(target, source, set_insert)
    if null_keys == "drop":
        source = source.where(~_null_key(keys))
    elif null_keys != "insert":
        raise ValueError("null_keys must be 'insert' or 'drop'")

    t = _spread(target, keys, -1, spread_nulls).alias("t")
    s = _spread(source, keys, 1, spread_nulls).alias("s")
    tkeys = keys + [SPREAD] if spread_nulls else keys
    if set_update is None:
        # Insert-only: new keys via anti join, no full outer join needed.
        new = s.join(t.select(*tkeys), on=_key_cond(keys, spread_nulls), how="left_anti")
        inserted = new.select([ins[c].alias(c) for c in cols])
        return target.unionByName(inserted)

    t = t.withColumn(T_FLAG, F.lit(True)).alias("t")
    s = s.withColumn(S_FLAG, F.lit(True)).alias("s")
    j = t.join(s, on=_key_cond(keys, spread_nulls), how="full_outer")
    only_s = F.col(f"t.{T_FLAG}").isNull()
    matched = F.col(f"t.{T_FLAG}").isNotNull() & F.col(f"s.{S_FLAG}").isNotNull()
    if update_when:
        matched = matched & any_distinct("t", "s", update_when)
    out = []
    for c in cols:
        if c in keys:
            e = F.when(only_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            upd = set_update.get(c, F.col(f"t.{c}"))
            e = F.when(only_s, ins[c]).when(matched, upd).otherwise(F.col(f"t.{c}"))
        out.append(e.alias(c))
    return j.select(out)


def update_where(target: DataFrame, ids: DataFrame, keys, set_cols: dict) -> DataFrame:
    """Keyed UPDATE of the target rows whose key is in ``ids``.

    ``set_cols`` maps column -> expression over the target's own columns.
    """
    keys = list(keys)
    hit = "__hit"
    marks = (ids.where(~_null_key(keys)).select(*keys).distinct()
             .withColumn(hit, F.lit(True))
             .withColumn(SPREAD, (F.spark_partition_id() * 0).cast("long")).alias("s"))   # see _spread
    t = _spread(target, keys, -1).alias("t")
    j = t.join(marks, on=_key_cond(keys), how="left")
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col(f"s.{hit}"), set_cols[c]).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}"))
    return j.select(out)
