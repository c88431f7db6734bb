"""Cases in which one plan or input used to give other results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions.scalars import full_match, strip_quotes, try_instant_ntz
from sluice.operators.dedupe import latest_wins
from sluice.operators.joins import enrich
from sluice.plans import highwater as hw
from sluice.session import scratch_path
from sluice.sources import sinks
from sluice.sources.landing import scan_csv, scan_ndjson_variant


def test_csv_policy_does_not_depend_on_the_projection(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,x,p\n2,y\n3,z,q\n4,y,r,s\n")
    df = scan_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert len(df.collect()) == df.count() == len(df.select("a").collect()) == 2
    assert df.groupBy("b").count().count() == 2
    strict = scan_csv(spark, str(tmp_path), ["a", "b", "c"], on_error="abort")
    for act in (strict.count, strict.select("a").collect, strict.collect):
        with pytest.raises(Exception):
            act()


def test_csv_quotes_commas_and_line_breaks(spark, tmp_path):
    title = 'Index, "1982=100", total'
    df = spark.createDataFrame([("k", title, "M"), ("k", "two\nlines", "N")], "g STRING, title STRING, units STRING")
    sinks.write_csv_partitioned(df, str(tmp_path / "out"), "g")
    got = scan_csv(spark, str(tmp_path / "out"), ["title", "units"], multi_line=True, provenance=False)
    assert sorted(map(tuple, got.collect())) == sorted([(title, "M"), ("two\nlines", "N")])
    assert [r.units for r in got.select("units").orderBy("units").collect()] == ["M", "N"]


def test_variant_abort_holds_for_counts(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\nnot json\n')
    df = scan_ndjson_variant(spark, str(tmp_path), on_error="abort")
    for act in (df.count, df.groupBy("source_file").count().collect):
        with pytest.raises(Exception):
            act()
    assert scan_ndjson_variant(spark, str(tmp_path)).count() == 1


def test_files_follow_keys_not_tasks(spark):
    path = scratch_path(spark, "t_keys")
    df = spark.range(0, 4000, 1, 16).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    sinks.write_csv_partitioned(df, path, "k")
    files = spark.read.option("header", "true").csv(path).select("_metadata.file_path").distinct().count()
    assert files <= 40


def test_clashing_export_names_are_an_error(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        sinks.export_frames({"a": df, "A": df}, scratch_path(spark, "t_clash"))


def test_observation_without_metadata_stays(spark):
    obs = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    meta = spark.createDataFrame([("a", "t")], "k STRING, title STRING")
    assert sorted(map(tuple, enrich(obs, meta, "k").collect())) == [("a", 1, "t"), ("b", 2, "")]


def test_mark_never_moves_back(spark):
    marks = spark.createDataFrame([("s", "", "", "", dt.date(2024, 1, 10), None, 0, None)], hw.MARKS_DDL)
    stats = spark.createDataFrame([("s", 3, dt.date(2024, 1, 8))], "series_id STRING, record_count INT, end_date DATE")
    assert hw.advance(marks, stats, None, "2024-02-01 00:00:00").first().last_observation_date == dt.date(2024, 1, 10)


def test_offsets_are_instants_and_ties_go_to_the_greater_file(spark):
    df = spark.createDataFrame([("k", 1, "2024-01-01T01:00:00+02:00", "f1"), ("k", 2, "2024-01-01T00:30:00+00:00", "f1"),
                                ("t", 9, "2024-01-01T00:00:00Z", "f1"), ("t", 1, "2024-01-01T00:00:00Z", "f2")],
                               "k STRING, value INT, at STRING, source_file STRING")
    typed = df.withColumn("at", try_instant_ntz("at"))
    got = {r.k: r.value for r in latest_wins(typed, ["k"], [F.col("at").desc_nulls_last()]).collect()}
    assert got == {"k": 2, "t": 1}
    with_map = typed.withColumn("m", F.create_map(F.lit("a"), "value"))
    assert latest_wins(with_map, ["k"], [F.col("at").desc_nulls_last()]).count() == 2


def test_line_breaks_in_matches_and_quotes(spark):
    df = spark.createDataFrame([("Brand#1\n",), ("Brand#1",), ('"a\nb"',)], "s STRING")
    assert [r[0] for r in df.select(full_match("s", "Brand#[0-9]")).collect()] == [False, True, False]
    assert df.select(strip_quotes("s")).collect()[2][0] == "a\nb"


def test_newest_version_is_the_last_commit(spark):
    from sluice.plans.snapshots import current, publish
    root = scratch_path(spark, "t_versions")
    publish(spark.range(1), root, "run9")
    publish(spark.range(2), root, "run10")
    spark.range(7).write.parquet(f"{root}/version=run99")       # a run that died before its commit
    assert current(spark, root).count() == 2
