"""Write PLANS.md: the physical plan Catalyst builds for selected registered
checks (the adaptive plan before run-time re-optimisation), with exchange and
join counts, at $PLANS_SF_DIR."""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sluice.session import build_session  # noqa: E402
from sluice.suite import load_all  # noqa: E402

SELECTED = {
    "latest_wins_lineitem": "W1: partial WindowGroupLimit below the only exchange",
    "merge_if_changed": "J2: dedupe partitioning reused by the full outer join (2 exchanges)",
    "merge_bucketed": "J2 on a bucketed snapshot: the target is read without an exchange",
    "delta_rows": "H4: plan broadcast behind the series-count bound; filters pushed into the scan",
    "grid_cross": "J5: Generate over a checked-size code list, no cross join",
    "flatten_agencies": "R1: projections and Generate only, no shuffle",
    "enrich_metadata": "J7: broadcast only after the row-count check",
    "pin_and_filter_level": "P2/P5: the literal level removes the lineitem branch",
    "bars_period": "S12/P12: symbol and date filters reach the scan",
    "top_n_per_group": "W3: partial limit before the shuffle",
}


def tree(plan: str) -> str:
    lines = plan.splitlines()
    out = []
    for line in lines:
        if line.startswith("(") or not line.strip():
            if out:
                break
            continue
        out.append(line)
    return "\n".join(out)


def main() -> None:
    sf_dir = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("local[8]", shuffle_partitions=8)
    reg = load_all()
    parts = ["# Physical plans of selected checks\n",
             f"Generated by `scripts/show_plans.py` at `{os.path.basename(sf_dir)}` on local[8]. "
             "These are the physical plans Catalyst builds; at run time AQE may still coalesce "
             "shuffle partitions or turn a sort-merge join with a small side into a broadcast join.\n"]
    from sluice.suite.curation import merge_bucketed_plan
    overrides = {"merge_bucketed": merge_bucketed_plan}
    for name, why in SELECTED.items():
        df = overrides.get(name, reg[name][0])(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        n_ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", plan)
        parts.append(f"## `{name}`\n\n{why}. Exchanges: {n_ex}; joins: {', '.join(joins) or 'none'}.\n")
        parts.append("```\n" + plan.strip() + "\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
