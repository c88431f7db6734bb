"""Hot keys: a third of all rows in one key or in null keys must not end up
in one task."""

import re

from pyspark.sql import functions as F

from sluice.operators.dedupe import latest_wins
from sluice.operators.explore import top_n_per_group
from sluice.operators.merge import merge


def _skewed(spark, n=30_000):
    # One key holds a third of all rows; the rest are spread.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 7 % 101).alias("v"))


def test_latest_wins_limits_hot_key_before_the_shuffle(spark):
    df = _skewed(spark).repartition(8)
    out = latest_wins(df, ["k"], [F.col("ts").desc()], tiebreak=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial limit below the exchange, final limit above it
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", plan)
    assert out.where("k = 0").first().ts == 29_997


def test_top_n_limits_hot_group_before_the_shuffle(spark):
    df = _skewed(spark).repartition(8)
    out = top_n_per_group(df, "k", [F.col("ts").desc()], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and out.where("k = 0").count() == 3


def test_null_key_rows_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # observe the raw partitioning
    try:
        tgt = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
                                        .cast("long").alias("k"), F.lit(1).alias("v"))
        src = spark.range(9_000, 9_100).select(F.col("id").alias("k"), F.lit(2).alias("v"))
        out = merge(tgt, src, ["k"], set_update={"v": F.col("s.v")})
        parts = (out.where(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(parts) >= 4                                  # not one hot partition
        assert sum(r["count"] for r in parts) == 3_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_update_where_spreads_null_keys(spark):
    from sluice.operators.merge import update_where
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tgt = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
                                        .cast("long").alias("k"), F.lit(0).alias("f"))
        ids = spark.range(10).select(F.col("id").alias("k"))
        out = update_where(tgt, ids, ["k"], {"f": F.col("f") + 1})
        parts = out.where(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 4
        assert out.where("f = 1").count() == 6            # keys 1, 2, 4, 5, 7, 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_assign_ids_splits_copies_of_one_key(spark):
    from sluice.operators.explore import assign_ids
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = assign_ids(df, "k", 0, "sid")
    ids = sorted(r.sid for r in out.collect())
    assert ids == list(range(1, 3_001))
    per_part = out.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_part) >= 2                     # the 1,000 copies are not in one task
