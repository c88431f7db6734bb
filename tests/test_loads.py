"""Loads with a reject store: results by file, commits, repeated loads."""

import pytest
from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.sources import loads
from sluice.sources.landing import scan_csv

COLS = ["a", "b", "c"]


def results(df):
    return sorted((r.source_file.rsplit("/", 1)[-1], r.status, r.rows_parsed, r.rows_loaded, r.rows_rejected, r.first_error)
                  for r in df.collect())


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "good.csv").write_text('a,b,c\n1,"x, ""y""","two\nlines"\n2,,z\n')
    (tmp_path / "deep" / "mixed.csv").write_text('h1,h2,h3\n3,x,p\n4,y\n5,y,"r,s",t\n')
    (tmp_path / "bad.csv").write_text("a,b,c\nonly one\n")
    (tmp_path / "empty.csv").write_text("a,b,c\n")
    (tmp_path / "zero.csv").write_text("")
    (tmp_path / "note.txt").write_text("not loaded")
    return str(tmp_path)


def test_results_rows_and_rejects(spark, landing):
    root = scratch_path(spark, "t_load")
    got = loads.load_csv(spark, landing, COLS, root, "r1", pattern="*.csv")
    assert results(got) == [
        ("bad.csv", "load_failed", 1, 0, 1, "expected 3 fields, found 1"),
        ("empty.csv", "loaded", 0, 0, 0, None),
        ("good.csv", "loaded", 2, 2, 0, None),
        ("mixed.csv", "partially_loaded", 3, 1, 2, "expected 3 fields, found 2")]
    rows = loads.loaded_rows(spark, root, COLS, {"a": "int"})
    assert sorted((r.a, r.b, r.c) for r in rows.collect()) == [(1, 'x, "y"', "two\nlines"), (2, None, "z"), (3, "x", "p")]
    assert rows.count() == rows.select("load_id").count() == scan_csv(spark, landing, COLS, pattern="*.csv").count() == 3
    assert sorted((r.record, r.error) for r in loads.rejects(spark, root, COLS).collect()) == [
        ("4,y", "expected 3 fields, found 2"), ('5,y,"r,s",t', "expected 3 fields, found 4"),
        ("only one", "expected 3 fields, found 1")]


def test_a_load_without_commit_does_not_count_and_is_replaced(spark, landing):
    root = scratch_path(spark, "t_load_crash")
    loads.load_csv(spark, f"{landing}/good.csv", COLS, root, "r1")
    # What a run leaves behind that dies before its commit.
    dead = spark.createDataFrame([("9", "9", "9", "f", None, None, False), ("9", "9", "9", "f", "x", "e", True)],
                                 "a STRING, b STRING, c STRING, source_file STRING, record STRING, error STRING, __reject BOOLEAN")
    dead.write.partitionBy("__reject").parquet(f"{root}/data/load_id=r2")
    assert loads.loaded_rows(spark, root, COLS).count() == 2 and loads.rejects(spark, root, COLS).count() == 0
    loads.load_csv(spark, f"{landing}/deep", COLS, root, "r2")
    loads.load_csv(spark, f"{landing}/deep", COLS, root, "r2")          # a replay
    assert loads.loaded_rows(spark, root, COLS).count() == 3 and loads.rejects(spark, root, COLS).count() == 2
    assert loads.load_results(spark, root).groupBy("load_id").count().count() == 2


def test_abort_keeps_the_table(spark, landing):
    root = scratch_path(spark, "t_load_abort")
    loads.load_csv(spark, f"{landing}/good.csv", COLS, root, "r1", on_error="abort")
    with pytest.raises(Exception):
        loads.load_csv(spark, f"{landing}/deep", COLS, root, "r2", on_error="abort")
    assert loads.loaded_rows(spark, root, COLS).select(F.min("load_id"), F.max("load_id")).first() == ("r1", "r1")


def test_no_file_content_is_read_for_the_listing(spark, landing):
    df = loads.file_results(spark, landing, spark.createDataFrame([], "source_file STRING, record STRING, error STRING, __reject BOOLEAN"),
                            "*.csv", True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and df.count() == 4
