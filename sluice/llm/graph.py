"""Connected components of an edge table, wholly in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link the greater neighbours of a node to the least of its
    neighbourhood. Small star: link the smaller ones and the node itself."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    joined = both.join(least, "u")          # a node with very many neighbours is split by AQE
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            least.select("u", F.col("low").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame | None:
    """``node, label`` of every node of the edges ``u, v``: the least node it is
    connected with (alternating large and small stars, each round written);
    None without edges. Done when no node that others point to points to
    another: every edge then leads to the least node of its component."""
    now = _written(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    if now.isEmpty():
        return None
    while True:
        now = _written(_star(_star(now, True), False), "stars")
        ends = now.select(F.col("v").alias("u")).distinct()
        # A node may point to several: that too is open.
        several = now.groupBy("u").count().filter("count > 1").select("u")
        if now.select("u").join(ends, "u", "left_semi").union(several).isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
