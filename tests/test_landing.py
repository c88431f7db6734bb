"""Bad-record policy and provenance of the landing scans."""

import pytest
from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.sources import landing


def test_ndjson_bad_line_continue_and_abort(spark):
    root = scratch_path(spark, "t_ndjson")
    spark.createDataFrame([('{"a": 1}',), ("{broken",), ('[{"a": 2}]',)], "value STRING") \
        .coalesce(1).write.text(root)
    ok = landing.scan_ndjson_variant(spark, root, on_error="continue", loaded_at="2024-01-01 00:00:00")
    assert ok.count() == 2                                   # outer array kept as one document
    assert ok.where(F.col("source_file").contains("part-")).count() == 2
    with pytest.raises(Exception):
        landing.scan_ndjson_variant(spark, root, on_error="abort").collect()


def test_csv_position_pattern_and_malformed(spark):
    root = scratch_path(spark, "t_csv")
    lines = ["date,value", "2020-01-01,1.5", "2020-13-01,nan", "2020-02-01,x", "2020-03-01,2,extra"]
    spark.createDataFrame([(s,) for s in lines], "value STRING").coalesce(1).write.text(f"{root}/series_id=GDP")
    # Text writer names files part-*.txt: only files matching the pattern are read.
    none = landing.scan_csv(spark, root, ["observation_date", "value"], pattern="*.csv")
    assert none.count() == 0
    df = landing.scan_csv(spark, root, ["observation_date", "value"], pattern="*.txt",
                          types={"observation_date": lambda c: F.try_to_date(c), "value": "double"})
    got = sorted((str(r.observation_date), r.value) for r in df.collect())
    assert got[0] == ("2020-01-01", 1.5)
    assert ("None", None) in [(a, b) for a, b in got if a == "None"] or any(a == "None" for a, _ in got)
    assert len(got) == 3                                     # the 3-field line is dropped
    with pytest.raises(Exception):
        landing.scan_csv(spark, root, ["observation_date", "value"], pattern="*.txt",
                         on_error="abort").collect()


def test_rebalanced_scan_keeps_rows_and_plans_a_rebalance(spark):
    root = scratch_path(spark, "t_gz")
    spark.range(2000).selectExpr("to_json(named_struct('a', id)) AS value").coalesce(1) \
        .write.option("compression", "gzip").text(root)
    df = landing.scan_ndjson_variant(spark, root, rebalance=True)
    assert df.count() == 2000
    assert "RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString()
