"""Plan audit of every registered check: no cartesian products or nested
loop joins, no Python evaluation, and single-partition exchanges only where
the data crossing them is bounded (global aggregates over one row per task,
limits that are the feature, the per-partition offsets of assign_ids)."""

import re

import pytest

from conftest import SF_SMALL
from sluice.suite import load_all

REGISTRY = load_all()
# Checks whose single-partition exchanges carry bounded data.
BOUNDED_SINGLE = {
    "random_sample": "top-n merge",
    "export_frames": "global row counts of exported frames",
    "key_quality": "global check counters",
    "assign_ids": "window over one row per partition",
    "tail_by_date": "top-n merge",
    "quotes_table": "top-n merge",
    "screen_tree": "top-n merge",
    "screen_presets": "top-n merge",
    "plan_subset": "top-n merge",
    "run_totals": "global totals",
    "catalog_listing": "a count of each table",
    "last_days": "top-n merge",
    "relative_periods": "last date",
    "order_by_month": "top-n merge",
    "grid_cross": "code list as one array",
    "missing_members": "calendar as one array",
    "arrest_request_plan": "code list as one array",
    "arrest_plan_all_grains": "code list as one array",
    "catalog_sampling": "bounded samples and their row counts",
}


def executed_plan(spark, name):
    df = REGISTRY[name][0](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_shape(spark, name):
    plan = executed_plan(spark, name)
    assert not re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan), plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), plan
    if name not in BOUNDED_SINGLE:
        assert "Exchange SinglePartition" not in plan, plan


def test_curated_merge_reuses_dedupe_partitioning(spark):
    plan = executed_plan(spark, "merge_if_changed")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_filters_reach_the_scan(spark):
    plan = executed_plan(spark, "bars_period")
    assert re.search(r"PartitionFilters: \[symbol#\d+ IN \(1-URGENT,2-HIGH\)\]", plan), plan   # pruning
    assert "GreaterThanOrEqual(bar_date,2001-07-28)" in plan                               # pushdown
    plan = executed_plan(spark, "pin_and_filter_level")
    assert "lineitem" not in plan          # the literal level removed the whole branch


def test_columns_are_pruned_at_the_scan(spark):
    plan = executed_plan(spark, "contains_ci")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan, plan
    plan = executed_plan(spark, "coverage")
    assert re.search(r"ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz,o_orderpriority:string>"
                     r"|ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderstatus:string,o_orderpriority:string>", plan) \
        or "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0], plan
