"""Dimension joins: grids and enrichment (J5, J7). Joins carry no hints: AQE
broadcasts a side whose size in bytes allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def grid(members: DataFrame, codes, code_name: str = "code") -> DataFrame:
    """Every member paired with every distinct non-null code of a code list:
    a list, or a one-column dimension frame, which is read as one array by a
    scalar subquery. The product is a Generate per member row (linear in the
    members); no join, and no code passes through the driver."""
    if isinstance(codes, DataFrame):
        found = codes.agg(F.array_sort(F.collect_set(codes.columns[0])).alias("codes"))
        return members.withColumn(code_name, F.explode(found.scalar()))
    if not codes:
        return members.withColumn(code_name, F.lit(None)).limit(0)
    return members.withColumn(code_name, F.explode(F.array(*[F.lit(c) for c in codes])))


def enrich(obs: DataFrame, meta: DataFrame, key) -> DataFrame:
    """Metadata columns beside each observation; an observation without
    metadata stays, its text columns empty."""
    keys = [key] if isinstance(key, str) else list(key)
    texts = [f.name for f in meta.schema.fields if f.name not in keys and isinstance(f.dataType, T.StringType)]
    joined = obs.join(meta, on=key, how="left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in texts})
