"""Runs that die anywhere, and ids claimed from a ledger."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sluice.plans import dimensions, sequences, snapshots
from sluice.plans import highwater as hw
from sluice.session import scratch_path
from sluice.suite import incremental

TS = "2024-02-01 00:00:00"


@pytest.fixture
def run(spark):
    root = scratch_path(spark, "t_protocol")
    obs = incremental.observations(spark, SF_SMALL)
    series = incremental.configured(spark)

    def extract(run_id, failed=incremental.failed_df(spark)):
        marks = (hw.latest_marks(spark, f"{root}/marks") if snapshots.last_commit(spark, f"{root}/marks")
                 else incremental.previous_marks(spark, SF_SMALL))
        return hw.run_extraction(obs, series, marks, incremental.meta_of(series), default_start=incremental.DEFAULT_START,
                                 run_ts=TS, run_id=run_id, landing_root=f"{root}/landing", failed=failed)
    return root, extract


def failures(spark, root):
    return {r.series_id: r.consecutive_failures for r in hw.latest_marks(spark, f"{root}/marks").collect()}


def test_a_crash_after_the_marks_and_a_replay(spark, run, monkeypatch):
    root, extract = run

    def dies(*a, **k):
        if a[3] == hw.COMMIT:
            raise ConnectionAbortedError
        return enter(*a, **k)
    enter = hw._enter
    with monkeypatch.context() as m:
        m.setattr(hw, "_enter", dies)
        with pytest.raises(ConnectionAbortedError):
            hw.commit_run(extract("r1"), f"{root}/log", f"{root}/marks", "r1", TS)
    first = failures(spark, root)
    assert first["click"] == 1 and hw.committed_log(spark, f"{root}/log").count() == 0
    assert [(r.run_id, r.committed) for r in hw.runs(spark, f"{root}/log").collect()] == [("r1", False)]
    # The same run again: its plan now follows from the marks it moved; log and marks stay.
    assert hw.commit_run(extract("r1"), f"{root}/log", f"{root}/marks", "r1", TS)
    assert not hw.commit_run(extract("r1"), f"{root}/log", f"{root}/marks", "r1", TS)
    log = hw.committed_log(spark, f"{root}/log")
    assert failures(spark, root) == first and log.count() == 6
    assert log.agg(F.sum("record_count")).first()[0] > 0
    assert hw.commit_run(extract("r2"), f"{root}/log", f"{root}/marks", "r2", TS)
    assert failures(spark, root)["click"] == 2
    assert {(r.run_id, r.n) for r in hw.committed_log(spark, f"{root}/log").groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {
        ("r1", 6), ("r2", 6)}


def test_claims_follow_each_other(spark, monkeypatch):
    ledger = scratch_path(spark, "t_claims")
    assert sequences.claim(spark, ledger, 10, after=5) == 6
    assert sequences.claim(spark, ledger, 3) == 16
    assert sequences.claim(spark, ledger, 1, after=100) == 101
    # Another writer takes the next number after this one has looked.
    look, looked = sequences.last_claim, []

    def late(spark_, ledger_):
        last = look(spark_, ledger_)
        if not looked:
            looked.append(last)
            spark.createDataFrame([(102, 111)], "first_id BIGINT, last_id BIGINT").write.parquet(f"{ledger}/number=4")
        return last
    monkeypatch.setattr(sequences, "last_claim", late)
    assert sequences.claim(spark, ledger, 2) == 112


def test_a_state_given_twice_gets_one_id(spark):
    empty = spark.createDataFrame([], "state_id BIGINT, state STRING, created_at TIMESTAMP_NTZ")
    ledger = scratch_path(spark, "t_state_ids")
    for how in (None, ledger):
        first = dimensions.seed_states(spark, empty, TS, ["WA", "AL", "WA", None, "OR", "AL"], how)
        assert sorted((r.state, r.state_id) for r in first.collect()) == [("AL", 1), ("OR", 2), ("WA", 3)]
    # A run that claimed and died: its ids are never given again.
    later = dimensions.seed_states(spark, empty, TS, ["NY"], ledger)
    assert [(r.state, r.state_id) for r in later.collect()] == [("NY", 4)]
    assert dimensions.seed_states(spark, first, TS, ["WA", "WA"], ledger).count() == 3
    codes = spark.createDataFrame([], "offense_code INT, created_at TIMESTAMP_NTZ")
    assert dimensions.seed_codes(spark, codes, [11, 11, None, 23], "offense_code", "INT", TS).count() == 2
