"""Invariants from the survey's test strategy, including a property test of
merge against a plain Python model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sluice.operators.aggregate import delta_stats
from sluice.operators.dedupe import duplicate_keys, latest_wins
from sluice.operators.merge import merge
from sluice.plans import highwater as hw
from sluice.suite import curation, incremental


def test_latest_wins_output_is_unique(spark):
    out = curation.latest_wins_events(spark, SF_SMALL)
    assert duplicate_keys(out, curation.EV_KEYS).count() == 0


def test_marks_never_move_backwards_and_replay_is_empty(spark):
    series, marks, plan, failed, delta, stats = incremental.scenario(spark, SF_SMALL)
    new_marks = hw.advance(marks, stats, incremental.meta_of(series), "2024-02-01 00:00:00")
    old = {r.series_id: r.last_observation_date for r in marks.collect()}
    for r in new_marks.collect():
        if r.series_id in old:
            assert r.last_observation_date >= old[r.series_id]
    # Re-planning from the advanced marks finds nothing new for the series
    # that succeeded.
    ok = stats.select("series_id")
    replan = hw.plan(series, new_marks, incremental.DEFAULT_START)
    again = hw.delta(incremental.observations(spark, SF_SMALL), replan)
    assert again.join(ok, "series_id", "left_semi").count() == 0


def test_failed_series_without_mark_is_not_counted(spark):
    marks = incremental.previous_marks(spark, SF_SMALL)
    bumped = hw.bump_failures(marks, incremental.failed_df(spark), "2024-02-01 00:00:00")
    got = {r.series_id: r.consecutive_failures for r in bumped.collect()}
    assert "refund" not in got and got["click"] == 1
    assert all(v == 0 for k, v in got.items() if k != "click")


def test_streaming_count_equals_batch(spark):
    from sluice.suite import streams
    n = streams.tick_count(spark, SF_SMALL).first().message_count
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert n == ev.where(F.col("event_type").isin(streams.SYMBOLS)).count()


keys = st.one_of(st.none(), st.integers(0, 5))
vals = st.one_of(st.none(), st.integers(0, 3))


def model_merge(target, source, update_when):
    """Plain Python MERGE: SQL equality on keys (null never matches)."""
    out = []
    src = {k: v for k, v in source if k is not None}
    for k, v, u in target:
        if k is not None and k in src:
            s = src[k]
            if update_when and s == v:
                out.append((k, v, u))
            else:
                out.append((k, s, "upd"))
        else:
            out.append((k, v, u))
    tkeys = {k for k, _v, _u in target if k is not None}
    for k, v in source:
        if k is None or k not in tkeys:
            out.append((k, v, "ins"))
    return out


def _norm(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(st.tuples(keys, vals), max_size=6),
       source=st.lists(st.tuples(keys, vals), max_size=6, unique_by=lambda r: r[0]),
       update_when=st.booleans())
def test_merge_matches_python_model(spark, target, source, update_when):
    tgt = spark.createDataFrame([(k, v, "old") for k, v in target], "k INT, v INT, u STRING")
    src = spark.createDataFrame(source, "k INT, v INT")
    out = merge(tgt, src, ["k"], set_update={"v": F.col("s.v"), "u": F.lit("upd")},
                set_insert={"u": F.lit("ins")}, update_when=["v"] if update_when else None)
    got = [(r.k, r.v, r.u) for r in out.collect()]
    assert _norm(got) == _norm(model_merge([(k, v, "old") for k, v in target], source, update_when))


def test_latest_wins_matches_python_model(spark):
    rows = [(k, ts, v) for k in (1, 2, None) for ts in (None, 1, 3, 2) for v in (5, 6)]
    df = spark.createDataFrame(rows, "k INT, ts INT, v INT")
    got = {r.k: (r.ts, r.v) for r in latest_wins(df, ["k"], [F.col("ts").desc_nulls_last()]).collect()}
    assert got == {1: (3, 6), 2: (3, 6), None: (3, 6)}


def test_delta_stats_last_date_is_max(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 3)), ("a", dt.date(2024, 1, 1))], "series_id STRING, d DATE")
    r = delta_stats(df, "series_id", "d").first()
    assert (r.record_count, r.end_date) == (2, dt.date(2024, 1, 3))


def model_latest(rows):
    """Per key the row with the greatest ts (nulls last), then greatest v."""
    best = {}
    for k, ts, v in rows:
        rank = (ts is not None, ts if ts is not None else 0, v is not None, v if v is not None else 0)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, ts, v))
    return sorted((r for _rank, r in best.values()), key=lambda r: [(x is None, str(x)) for x in r])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 4)), vals), min_size=1, max_size=12))
def test_latest_wins_matches_python_model_random(spark, data):
    df = spark.createDataFrame(data, "k INT, ts INT, v INT")
    out = latest_wins(df, ["k"], [F.col("ts").desc_nulls_last()])
    got = sorted(((r.k, r.ts, r.v) for r in out.collect()), key=lambda r: [(x is None, str(x)) for x in r])
    assert got == model_latest(data)


def model_month(text):
    parts = text.strip().split("-") if text is not None else []
    if len(parts) != 2:
        return None
    try:
        m, y = int(parts[0]), int(parts[1])
    except ValueError:
        return None
    if not (1 <= m <= 12 and 1 <= y <= 9999):
        return None
    return dt.date(y, m, 1)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.builds(lambda m, y: f"{m:02d}-{y}", st.integers(0, 14), st.integers(1990, 2030)),
    st.builds(lambda m, y: f"{m}-{y}", st.integers(1, 12), st.integers(1990, 2030)),
    st.sampled_from(["bad", "1-2-2020", "", " 03-2021 ", "13-2020", "00-2020"])), min_size=1, max_size=10))
def test_month_text_matches_python_model(spark, texts):
    from sluice.functions.scalars import month_text_date
    df = spark.createDataFrame([(t,) for t in texts], "m STRING")
    got = [(r.m, r.d) for r in df.select("m", month_text_date("m").alias("d")).collect()]
    assert got == [(t, model_month(t)) for t in texts]


def model_payload_rows(payload):
    """Records of a response the way the reference coerces it to a frame."""
    import json as _json
    if payload is None or not payload.strip():
        return []
    data = _json.loads(payload)
    if isinstance(data, list):
        return data
    if isinstance(data, dict):
        for v in data.values():
            if isinstance(v, list) and v:
                return v
        return [data] if data else []
    return []


records = st.lists(st.fixed_dictionaries({"a": st.integers(0, 9)}), max_size=3)
payload_values = st.one_of(records, st.integers(0, 3), st.text(alphabet="xy[]{}\", 1", max_size=4),
                           st.fixed_dictionaries({"a": st.integers(0, 9)}))
payloads = st.one_of(records, st.dictionaries(st.sampled_from(["m", "n", "p", "q"]), payload_values, max_size=4))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payloads, min_size=1, max_size=5))
def test_payload_rows_matches_python_model(spark, docs):
    import json as _json
    from sluice.operators.reshape import payload_rows
    texts = [_json.dumps(d) for d in docs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, p STRING")
    got = sorted((r.i, _json.dumps(_json.loads(r.record), sort_keys=True))
                 for r in payload_rows(df, "p", keep=["i"]).collect())
    want = sorted((i, _json.dumps(rec, sort_keys=True)) for i, t in enumerate(texts)
                  for rec in model_payload_rows(t))
    assert got == want


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(keys, max_size=6), source=st.lists(keys, max_size=6))
def test_insert_only_merge_matches_python_model(spark, target, source):
    tgt = spark.createDataFrame([(k, "old") for k in target], "k INT, c STRING")
    src = spark.createDataFrame([(k,) for k in source], "k INT")
    out = merge(tgt, src, ["k"], set_update=None, set_insert={"c": F.lit("new")})
    got = sorted(((r.k, r.c) for r in out.collect()), key=lambda r: [(x is None, str(x)) for x in r])
    tkeys = {k for k in target if k is not None}
    want = [(k, "old") for k in target] + [(k, "new") for k in source if k is None or k not in tkeys]
    assert got == sorted(want, key=lambda r: [(x is None, str(x)) for x in r])


def test_full_refresh_run_ignores_and_keeps_marks(spark):
    from sluice.session import scratch_path
    series = incremental.configured(spark)
    marks = incremental.previous_marks(spark, SF_SMALL)
    root = scratch_path(spark, "t_full_refresh")
    out = hw.run_extraction(incremental.observations(spark, SF_SMALL), series, marks,
                            incremental.meta_of(series), default_start=incremental.DEFAULT_START,
                            run_ts="2024-02-01 00:00:00", run_id="r1", landing_root=f"{root}/landing",
                            use_marks=False)
    assert out.marks is None                                     # H10: marks are not written
    starts = {r.start_date for r in out.plan.collect()}
    assert starts == {dt.date(2024, 1, 10)}                      # every series from the default start
    hw.commit_run(out, f"{root}/log", f"{root}/marks", "r1")
    assert spark.read.parquet(f"{root}/log").count() == out.plan.count()
