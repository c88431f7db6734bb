"""Edge cases of the reference's semantics on small inline frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sluice.functions.predicates import any_distinct, contains_ci
from sluice.functions.scalars import (falsy_or, first_token, full_match, month_text_date, month_text_year,
                                      percent, sanitize_ident, strip_control, strip_quotes)
from sluice.operators.dedupe import assert_unique, latest_wins
from sluice.operators.explore import assign_ids, predicate, tail_by, top_k
from sluice.operators.joins import grid
from sluice.operators.merge import merge, update_where
from sluice.operators.reshape import flatten_agencies, monthly_long, payload_rows
from sluice.plans.params import select_member


def _key(t):
    return [(v is None, str(v)) for v in t]


def norm(items):
    return sorted(items, key=_key)


def rows(df, *cols):
    cols = cols or df.columns
    return norm(tuple(r[c] for c in cols) for r in df.collect())


def test_month_text_parsing(spark):
    df = spark.createDataFrame([("01-2020",), ("13-2020",), ("bad",), ("1-2-2020",), ("12-1999",), (None,)], "m STRING")
    out = df.select("m", month_text_date("m").alias("d"), month_text_year("m").alias("y")).collect()
    got = {r.m: (r.d, r.y) for r in out}
    assert got["01-2020"] == (dt.date(2020, 1, 1), 2020)
    assert got["12-1999"] == (dt.date(1999, 12, 1), 1999)
    for bad in ("13-2020", "bad", "1-2-2020", None):
        assert got[bad] == (None, None)


def test_latest_wins_nulls_last_and_deterministic_ties(spark):
    df = spark.createDataFrame([
        ("a", None, 1.0), ("a", dt.datetime(2024, 1, 2), 2.0), ("a", dt.datetime(2024, 1, 1), 3.0),
        ("b", None, 5.0), ("b", None, 4.0),            # all order columns tie: rest decides
    ], "k STRING, ext TIMESTAMP_NTZ, v DOUBLE")
    out = latest_wins(df, ["k"], [F.col("ext").desc_nulls_last()])
    assert rows(out, "k", "v") == norm([("a", 2.0), ("b", 5.0)])


def test_merge_unconditional_and_null_keys(spark):
    tgt = spark.createDataFrame([(1, "x", 0), (2, "y", 0), (None, "n", 0)], "k INT, v STRING, u INT")
    src = spark.createDataFrame([(2, "Y"), (3, "z"), (None, "m")], "k INT, v STRING")
    out = merge(tgt, src, ["k"], set_update={"v": F.col("s.v"), "u": F.lit(9)},
                set_insert={"u": F.lit(7)})
    assert rows(out, "k", "v", "u") == norm([(1, "x", 0), (2, "Y", 9), (3, "z", 7), (None, "n", 0), (None, "m", 7)])
    dropped = merge(tgt, src, ["k"], set_update={"v": F.col("s.v")}, null_keys="drop")
    assert dropped.where(F.col("k").isNull()).count() == 1


def test_merge_twice_equals_once_for_non_null_keys(spark):
    tgt = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k INT, v DOUBLE")
    src = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k INT, v DOUBLE")
    once = merge(tgt, src, ["k"], set_update={"v": F.col("s.v")})
    twice = merge(once, src, ["k"], set_update={"v": F.col("s.v")})
    assert rows(once) == rows(twice)


def test_change_only_merge_keeps_unchanged_and_treats_nan_equal(spark):
    tgt = spark.createDataFrame([(1, float("nan"), "old"), (2, 1.0, "old"), (3, None, "old")],
                                "k INT, v DOUBLE, u STRING")
    src = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "k INT, v DOUBLE")
    out = merge(tgt, src, ["k"], set_update={"v": F.col("s.v"), "u": F.lit("new")}, update_when=["v"])
    got = {r.k: r.u for r in out.collect()}
    assert got == {1: "old", 2: "new", 3: "old"}


def test_insert_only_merge_is_idempotent(spark):
    tgt = spark.createDataFrame([("CA", "t0")], "s STRING, c STRING")
    src = spark.createDataFrame([("CA",), ("NY",)], "s STRING")
    once = merge(tgt, src, ["s"], set_update=None, set_insert={"c": F.lit("t1")})
    twice = merge(once, src, ["s"], set_update=None, set_insert={"c": F.lit("t2")})
    assert rows(once) == norm([("CA", "t0"), ("NY", "t1")]) == rows(twice)


def test_update_where_only_touches_listed_keys(spark):
    marks = spark.createDataFrame([("a", 0), ("b", None), (None, 3)], "id STRING, f INT")
    failed = spark.createDataFrame([("b",), ("zz",)], "id STRING")
    out = update_where(marks, failed, ["id"], {"f": F.coalesce("f", F.lit(0)) + 1})
    assert rows(out, "id", "f") == norm([("a", 0), ("b", 1), (None, 3)])


def test_assert_unique_raises(spark):
    df = spark.createDataFrame([(1,), (1,)], "k INT")
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])


def test_json_null_is_not_missing_but_typed_filter_drops_it(spark):
    df = spark.createDataFrame([('{"a": null}',), ('{"b": 1}',), ('{"a": 5}',)], "j STRING")
    v = df.select(F.try_parse_json("j").alias("d"))
    out = v.select(F.try_variant_get("d", "$.a", "int").alias("a")).where(F.col("a").isNotNull())
    assert rows(out) == [(5,)]


def test_first_object_series_wins_and_rejects(spark):
    payload = ('{"actuals": {"note": "x", "Arrests": {"01-2020": 5, "13-2020": 1, "02-2020": null},'
               ' "Other": {"01-2020": 99}}}')
    df = spark.createDataFrame([(payload,)], "p STRING")
    out = monthly_long(df, "p").collect()
    assert {r.series_label for r in out} == {"Arrests"}
    good = {(r.observation_date, r.value) for r in out if r.observation_date}
    assert good == {(dt.date(2020, 1, 1), 5.0), (dt.date(2020, 2, 1), None)}
    assert [r.month_text for r in out if r.observation_date is None] == ["13-2020"]


def test_flatten_skips_non_list_members_and_non_objects(spark):
    payload = '{"Adams": [{"ori": "A1", "county_name": "wrong"}, 7], "meta": "x", "Baker": [{"ori": "B1"}]}'
    df = spark.createDataFrame([(payload, "WA")], "p STRING, state STRING")
    out = flatten_agencies(df, "p", "ori STRING, county_name STRING", keep=["state"])
    assert rows(out, "ori", "county_name", "state") == norm([("A1", "Adams", "WA"), ("B1", "Baker", "WA")])


def test_payload_coercion_shapes(spark):
    df = spark.createDataFrame([
        ("l", '[{"a": 1}, {"a": 2}]'), ("d", '{"meta": {"x": 1}, "none": [], "rows": [{"a": 3}]}'),
        ("s", '{"a": 4}'), ("e1", "[]"), ("e2", "{}"), ("e3", ""), ("e4", None)], "tag STRING, p STRING")
    out = payload_rows(df, "p", keep=["tag"]).select("tag", F.get_json_object("record", "$.a").alias("a"))
    assert rows(out) == norm([("d", "3"), ("l", "1"), ("l", "2"), ("s", "4")])


def test_scalar_helpers(spark):
    df = spark.createDataFrame([('"quoted"', "GDP  (real)", "a\x01b\tc", "x y/z", 0.0, 2.5, 0.02675)],
                               "q STRING, s STRING, c STRING, i STRING, a DOUBLE, b DOUBLE, r DOUBLE")
    r = df.select(strip_quotes("q").alias("q"), first_token("s").alias("s"), strip_control("c").alias("c"),
                  sanitize_ident("i").alias("i"), falsy_or("a", "b").alias("f"), percent("r").alias("p"),
                  full_match("s", "GDP.*").alias("m"), contains_ci("s", "gdp").alias("ci")).first()
    assert (r.q, r.s, r.c, r.i, r.f, r.m, r.ci) == ("quoted", "GDP", "ab\tc", "x_y_z", 2.5, True, True)
    assert math.isclose(r.p, 2.68)


def test_any_distinct_is_null_safe(spark):
    a = spark.createDataFrame([(1, None, 1.0), (2, None, None)], "k INT, x STRING, y DOUBLE").alias("t")
    b = spark.createDataFrame([(1, None, 1.0), (2, "v", None)], "k INT, x STRING, y DOUBLE").alias("s")
    out = a.join(b, F.col("t.k") == F.col("s.k")).select("t.k", any_distinct("t", "s", ["x", "y"]).alias("d"))
    assert rows(out) == norm([(1, False), (2, True)])


def test_assign_ids_are_consecutive_across_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(13)
    out = assign_ids(df, "k", 500, "sid").collect()
    assert sorted((r.k, r.sid) for r in out) == [(k, 501 + k) for k in range(1000)]


def test_grid_of_a_list_and_of_a_frame(spark):
    codes = spark.createDataFrame([(3,), (1,), (None,), (3,)], "c INT")
    members = spark.createDataFrame([("CA",), ("NY",)], "m STRING")
    want = norm([("CA", 1), ("CA", 3), ("NY", 1), ("NY", 3)])
    assert rows(grid(members, [1, 3], "code")) == rows(grid(members, codes, "code")) == want
    assert rows(grid(members, codes.limit(0), "code")) == rows(grid(members, [], "code")) == []


def test_screen_tree_and_topk(spark):
    df = spark.createDataFrame([(1, "tech", 10, 5.0), (2, "tech", 40, 7.0), (3, "food", 12, 9.0),
                                (4, "tech", 15, None)], "id INT, sector STRING, pe INT, cap DOUBLE")
    tree = ("and", [("is-in", "sector", ["tech"]), ("or", [("btwn", "pe", 5, 20), ("gte", "cap", 7.0)])])
    assert rows(df.where(predicate(tree)), "id") == norm([(1,), (2,), (4,)])
    top = top_k(df, "cap", False, 2, tiebreak=["id"]).collect()
    assert [r.id for r in top] == [3, 2]
    tail = tail_by(df, "id", 2).collect()
    assert [r.id for r in tail] == [3, 4]


def test_select_member_validates(spark):
    df = spark.createDataFrame([("CA",), ("NY",)], "s STRING")
    assert select_member(df, "s", "all", ["CA", "NY"]).count() == 2
    assert select_member(df, "s", "ny", ["CA", "NY"]).count() == 1
    with pytest.raises(ValueError):
        select_member(df, "s", "ZZ", ["CA", "NY"])


def test_merge_with_map_columns_and_many_null_keys(spark):
    tgt = spark.createDataFrame([(None, {"a": "1"})] * 50 + [(1, {"b": "2"})], "k INT, m MAP<STRING,STRING>")
    src = spark.createDataFrame([(None, {"c": "3"}), (1, {"d": "4"})], "k INT, m MAP<STRING,STRING>")
    out = merge(tgt, src, ["k"], set_update={"m": F.col("s.m")})
    assert out.where(F.col("k").isNull()).count() == 51
    assert out.where(F.col("k") == 1).first().m == {"d": "4"}


def test_flatten_rebalance_keeps_results(spark):
    counties = ", ".join(f'"C{i}": [{{"ori": "O{i}a"}}, {{"ori": "O{i}b"}}]' for i in range(40))
    df = spark.createDataFrame([("{" + counties + "}", "WA")], "p STRING, state STRING")
    a = flatten_agencies(df, "p", "ori STRING", keep=["state"])
    b = flatten_agencies(df, "p", "ori STRING", keep=["state"], rebalance=8)
    assert rows(a) == rows(b) and len(rows(a)) == 80
    assert b.rdd.getNumPartitions() == 8


def test_blank_or_for_text(spark):
    from sluice.functions.scalars import blank_or
    df = spark.createDataFrame([("", "x"), (None, "y"), ("0", "z")], "a STRING, b STRING")
    assert [r.v for r in df.select(blank_or("a", "b").alias("v")).collect()] == ["x", "y", "0"]
