"""Smaller helpers: defaults, ordering, period filters, sinks, live stream."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from sluice.functions.predicates import between, find_col, optional_eq, where_in
from sluice.operators.explore import order_by_month, sort_if_present, top_n_per_group
from sluice.plans.params import run_sql
from sluice.session import local_path, scratch_path
from sluice.sources import sinks
from sluice.streaming import ticks


def test_with_defaults_and_ensure_table(spark):
    df = spark.createDataFrame([("a", None), ("b", 3)], "k STRING, n INT")
    out = sinks.with_defaults(df, {"n": 0, "created_at": F.lit("x")})
    assert sorted((r.k, r.n, r.created_at) for r in out.collect()) == [("a", 0, "x"), ("b", 3, "x")]
    path = scratch_path(spark, "t_table")
    name = "t_table_" + path.rsplit("-", 1)[-1]
    sinks.ensure_table(spark, name, "k STRING, n INT", path)
    sinks.ensure_table(spark, name, "k STRING, n INT", path)          # idempotent
    sinks.land(df, path, mode="append")
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 2


def test_order_by_month_and_sort_nulls_last(spark):
    df = spark.createDataFrame([("02-2020",), ("11-2019",), ("bad",), ("01-2020",)], "m STRING")
    assert [r.m for r in order_by_month(df, "m").collect()] == ["11-2019", "01-2020", "02-2020", "bad"]
    df2 = spark.createDataFrame([(None,), (2,), (1,)], "x INT")
    assert [r.x for r in sort_if_present(df2, ["x", "absent"]).collect()] == [1, 2, None]


def test_between_optional_eq_where_in_find_col(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d), f"S{d}") for d in range(1, 8)], "d DATE, s STRING")
    assert between(df, "d", dt.date(2020, 1, 3), dt.date(2020, 1, 5)).count() == 3
    assert optional_eq(df, "s", " s2 ").count() == 1
    assert optional_eq(df, "s", "").count() == 7
    assert where_in(df, "s", ["S1", "S7", "S9"]).count() == 2
    assert where_in(df, "s", [f"S{i}" for i in range(2000)]).count() == 7
    assert find_col(spark.createDataFrame([(1, 2)], "offense_name INT, actual_count INT"), ["count"]) == "actual_count"
    # Column order decides, not the order of the fragments.
    assert find_col(spark.createDataFrame([(1, 2)], "actual_total INT, rate_count INT"), ["count", "actual"]) == "actual_total"


def test_run_sql_optional_clause(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "id INT, s STRING").createOrReplaceTempView("t_params")
    q = "SELECT id FROM IDENTIFIER(:t) WHERE (:s IS NULL OR s = :s)"
    assert run_sql(spark, q, {"t": "t_params", "s": ""}).count() == 2
    assert run_sql(spark, q, {"t": "t_params", "s": "b"}).count() == 1


def test_top_n_per_group_keeps_ties_out(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 5)], "g STRING, v INT")
    out = top_n_per_group(df, "g", [F.col("v").desc()], 1).collect()
    assert sorted((r.g, r.v) for r in out) == [("a", 1), ("b", 5)]


def test_summary_and_exports(spark):
    root = scratch_path(spark, "t_export")
    df = spark.createDataFrame([(1,)], "n INT")
    names = sinks.export_frames({"kept": df, "empty": df.where("n > 5"), "missing": None,
                                 "a_very_long_frame_name_that_is_written_in_full_1": df,
                                 "a_very_long_frame_name_that_is_written_in_full_2": df.union(df)}, root, prefix="x_")
    assert names == ["x_kept", *(f"x_a_very_long_frame_name_that_is_written_in_full_{k}" for k in (1, 2))]
    assert [spark.read.parquet(f"{root}/{n}").count() for n in names] == [1, 1, 2]
    sinks.write_summary(df, f"{root}/summary")
    files = [f for f in os.listdir(local_path(f"{root}/summary")) if f.endswith(".json")]
    assert len(files) == 1
    with open(os.path.join(local_path(f"{root}/summary"), files[0])) as fh:
        assert json.loads(fh.readline()) == {"n": 1}


def test_live_stream_runs_for_bounded_time(spark):
    src = scratch_path(spark, "t_ticks_src")
    spark.createDataFrame([("AAPL", 0.0, 10.5, "t1"), ("MSFT", 2.0, 3.0, "t2"), (None, None, 4.0, None)],
                          "id STRING, price DOUBLE, regularMarketPrice DOUBLE, time STRING") \
        .write.parquet(src)
    schema = "id STRING, price DOUBLE, regularMarketPrice DOUBLE, time STRING"
    stream = ticks.project_ticks(ticks.read_ticks(spark, src, schema))
    out = scratch_path(spark, "t_ticks_out")
    q = ticks.collect_to(stream, f"{out}/data", f"{out}/ckpt", available_now=False)
    q.processAllAvailable()
    ticks.run_for(q, 0.5)
    assert not q.isActive
    got = sorted((r.id, r.price, r.time) for r in spark.read.parquet(f"{out}/data").collect())
    assert got == [("?", 4.0, ""), ("AAPL", 10.5, "t1"), ("MSFT", 2.0, "t2")]


def test_catalog_sampling_skips_broken_view(spark):
    from conftest import SF_SMALL
    from sluice.suite import load_all
    rows = load_all()["catalog_sampling"][0](spark, SF_SMALL).collect()
    got = {r.table_name: (r.export_name, r.sampled_rows) for r in rows}
    assert "sluice_sample_broken" not in got
    assert len(got) == 16
    assert got["sluice_sample_region"][1] == 5
    assert got["sluice_sample_lineitem"][1] == 1000
    assert all(export == table for table, (export, _n) in got.items())


def test_listing_has_creation_time_for_catalog_tables(spark):
    from sluice.sources.landing import list_tables
    path = scratch_path(spark, "t_listing")
    name = "t_listing_" + path.rsplit("-", 1)[-1]
    sinks.ensure_table(spark, name, "k STRING", path)
    row = [r for r in list_tables(spark).collect() if r.table_name == name][0]
    assert row.created and not row.is_temporary


def test_assert_not_empty(spark):
    import pytest
    from sluice.operators.quality import assert_not_empty
    df = spark.range(3)
    assert assert_not_empty(df) is df
    with pytest.raises(RuntimeError):
        assert_not_empty(df.where("id > 5"), "grid")
