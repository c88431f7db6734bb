"""Aggregates at several grains and pivots with unknown members read once."""

import pytest
from pyspark.sql import functions as F

from sluice.operators.aggregate import grain_totals
from sluice.operators.joins import grid
from sluice.operators.reshape import member_names, pivot_sum


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture
def sales(spark, tmp_path):
    rows = [("a", 1, "x", 2.0), ("a", 1, "y", 3.0), ("a", 2, "x", 4.0), ("b", 1, None, 5.0), (None, 1, "x", 6.0), ("b", 2, "x", None)]
    spark.createDataFrame(rows, "k STRING, y INT, m STRING, v DOUBLE").write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_grains_of_one_scan(spark, sales):
    out = grain_totals(sales, {"k": ["k", "y"], "m": ["y", "m"], "all": []}, {"v": F.col("v"), "n": F.lit(1)})
    assert scans(out) == 1
    got = {(r.level, r.k, r.y, r.m): (r.v, r.n) for r in out.collect()}
    assert got["all", None, None, None] == (20.0, 6)
    assert got["k", None, 1, None] == (6.0, 1) and got["k", "b", 2, None] == (None, 1) and got["k", "a", 1, None] == (5.0, 2)
    assert got["m", None, 1, None] == (5.0, 1) and got["m", None, 1, "x"] == (8.0, 2)
    assert len(got) == 1 + 5 + 4
    with pytest.raises(ValueError):
        grain_totals(sales, {"a": ["k", "y"], "b": ["y", "k"]}, {"v": F.col("v")})


def test_pivot_with_unknown_members(spark, sales):
    wide = pivot_sum(sales, "k", "m", "v")
    assert wide.columns == ["k", "null", "x", "y"] and scans(wide) == 0        # the rest is from the written aggregate
    assert {r.k: (r["null"], r.x, r.y) for r in wide.collect()} == {
        "a": (None, 6.0, 3.0), "b": (5.0, None, None), None: (None, 6.0, None)}
    fixed = pivot_sum(sales, "k", "m", "v", ["x", "z"])
    assert {r.k: (r.x, r.z) for r in fixed.collect()} == {"a": (6.0, None), "b": (None, None), None: (6.0, None)}
    assert pivot_sum(sales.limit(0), "k", "m", "v").columns == ["k"]


def test_names_of_records_in_their_order(spark):
    df = spark.createDataFrame([(["year", "actual_count"],), (["year", "offense", "z"],), (None,)], "names ARRAY<STRING>")
    assert member_names(df, "names") == ["year", "actual_count", "offense", "z"]


def test_grid_needs_no_join(spark, sales):
    plan = grid(sales.select("k"), sales.select("y"), "code")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate explode" in plan
