"""Snapshots merged by slices and by buckets, and their commits."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.plans import snapshots
from sluice.session import local_path, scratch_path


def _files(path):
    out = {}
    for root, _dirs, files in os.walk(local_path(path)):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def by_day(spark):
    root = scratch_path(spark, "t_snapshot")
    tgt = spark.createDataFrame([(d, k, float(k)) for d in ("2024-01-01", "2024-01-02", "2024-01-03")
                                 for k in range(5)], "day STRING, k INT, v DOUBLE")
    snapshots.create_partitioned(tgt, root, "day")
    return root


SOURCE = [("2024-01-03", 1, 10.0), ("2024-01-03", 9, 9.0), ("2024-01-04", 0, 4.0)]


def merge_days(spark, root, rows=SOURCE):
    src = spark.createDataFrame(rows, "day STRING, k INT, v DOUBLE")
    return snapshots.merge_partitioned(root, src, ["day", "k"], "day", set_update={"v": F.col("s.v")}, spread_nulls=False,
                                       null_keys="drop")


def test_only_touched_slices_are_written_and_once(spark, by_day):
    before = _files(f"{by_day}/data")
    assert merge_days(spark, by_day) == 2
    after = _files(f"{by_day}/data")
    assert all(after.get(f) == t for f, t in before.items())
    new = {f for f in after if f not in before}
    assert {f.split("slice=2/")[1].split("/")[0] for f in new} == {"day=2024-01-03", "day=2024-01-04"}
    got = {(r.day, r.k): r.v for r in snapshots.partitioned(spark, by_day, "day").collect()}
    assert len(got) == 17 and got["2024-01-03", 1] == 10.0 and got["2024-01-01", 1] == 1.0
    assert dict(snapshots.partitioned(spark, by_day, "day").dtypes) == {"day": "string", "k": "int", "v": "double"}
    assert merge_days(spark, by_day, []) == 2                   # nothing to merge, no commit


def test_the_source_prunes_the_folders(spark, by_day):
    merge_days(spark, by_day)
    staged = scratch_path(spark, "t_staged")
    spark.createDataFrame(SOURCE, "day STRING, k INT, v DOUBLE").withColumn("number", F.lit(1)).write.parquet(staged)
    source = spark.read.parquet(staged).where("number = 1")
    touched = snapshots.touched_slices(spark, by_day, source, "day")
    scans = [line for line in touched._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "v#" in line]
    assert any("dynamicpruning" in line for line in scans), scans
    assert touched.count() == 7


def test_a_crash_before_the_commit_leaves_the_old_state(spark, by_day, monkeypatch):
    def dies(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", dies)
        with pytest.raises(RuntimeError):
            merge_days(spark, by_day)
    assert snapshots.partitioned(spark, by_day, "day").count() == 15
    assert merge_days(spark, by_day) == 2                       # the run again
    assert snapshots.partitioned(spark, by_day, "day").count() == 17
    assert merge_days(spark, by_day, [("2024-01-04", 0, 5.0)]) == 3
    assert {r.v for r in snapshots.partitioned(spark, by_day, "day").where("day = '2024-01-04'").collect()} == {5.0}


def test_two_drivers_cannot_commit_one_number(spark, by_day):
    schema = snapshots.partitioned(spark, by_day, "day").schema
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshots.commit(spark, by_day, 1, "other", schema)


def test_partition_column_is_a_key_without_nulls(spark, by_day):
    df = spark.createDataFrame([(1, "a")], "k INT, p STRING")
    with pytest.raises(ValueError):
        snapshots.merge_partitioned("/nonexistent", df, ["k"], "p")
    with pytest.raises(Exception, match="null in the partition column"):
        snapshots.replace_partitions(spark.createDataFrame([(None, 1, 1.0)], "day STRING, k INT, v DOUBLE"), by_day, "day")
    assert snapshots.partitioned(spark, by_day, "day").count() == 15


def _bucketed(spark, size, target):
    path = scratch_path(spark, "t_bucketed")
    name = "t_bucketed_" + path.rsplit("-", 1)[-1]
    tgt = spark.range(2_000).select((F.col("id") % 500).alias("k"), (F.col("id") / 500).cast("int").alias("j"),
                                    F.lit(1.0).alias("v"))
    snapshots.write_bucketed(tgt, name, ["k", "j"], path, size, target)
    return name, path


def test_bucketed_target_is_not_shuffled_and_the_source_once(spark):
    from sluice.operators.dedupe import latest_wins
    name, _ = _bucketed(spark, 800, 100)
    assert snapshots.bucket_state(spark, name)[:2] == (8, 100)
    src = spark.createDataFrame([(1, 0, 5.0), (1, 0, 4.0), (7, 9, 6.0)], "k BIGINT, j INT, v DOUBLE")
    out = snapshots.merged_buckets(spark, name, src, ["k", "j"], 8, lambda s: latest_wins(s, ["k", "j"], [F.col("v").desc()]),
                                   set_update={"v": F.col("s.v")}, spread_nulls=False, null_keys="drop")
    assert "Bucketed: true" in plan_of(out)
    assert plan_of(out).count("Exchange") == 1                  # the source, ranked and joined under one
    got = {(r.k, r.j): r.v for r in out.collect()}
    assert len(got) == 2_001 and got[(1, 0)] == 5.0 and got[(7, 9)] == 6.0


def test_buckets_follow_the_bytes(spark):
    assert [snapshots.buckets_for(b, 100) for b in (0, 1, 100, 101, 200, 201, 1000)] == [1, 1, 1, 2, 2, 4, 16]
    name, path = _bucketed(spark, 100, 100)                     # far too few for what it holds
    assert snapshots.bucket_state(spark, name)[0] == 1 and snapshots.bytes_at(spark, path) > 1000
    src = spark.createDataFrame([(1, 0, 5.0)], "k BIGINT, j INT, v DOUBLE")
    out = snapshots.merge_bucketed(spark, name, src, ["k", "j"], f"{name}_v2", f"{path}_v2", set_update={"v": F.col("s.v")})
    assert out.count() == 2_000
    buckets, target, _ = snapshots.bucket_state(spark, f"{name}_v2")
    assert buckets == snapshots.buckets_for(snapshots.bytes_at(spark, path), 100) > 8 and target == 100


def test_versioned_snapshots(spark):
    root = scratch_path(spark, "t_versions")
    snapshots.publish(spark.createDataFrame([(1, "a")], "k INT, v STRING"), root, "20240101_000000")
    prev = snapshots.current(spark, root)
    nxt = prev.unionByName(spark.createDataFrame([(2, "b")], "k INT, v STRING"))
    snapshots.publish(nxt, root, "20240201_000000")                      # reads v1, writes v2
    assert sorted((r.k, r.v) for r in snapshots.current(spark, root).collect()) == [(1, "a"), (2, "b")]
