"""Write PLANS.md: operator counts and the physical plan of the headline
queries (``python tests/plan_report.py [sf_dir]``)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["r1_pivot_metrics", "r2_create_grid", "b1_build_blocks", "b1_build_blocks_sliced",
            "d6_d7_detect_anomalies", "b6_event_blocks", "r5_resample_sensor_near",
            "c13_auc_by_block_sensor", "c14_roc_curve", "z6_top_gaps", "q1_prepare",
            "q2_anomaly_report", "q3_maintenance_report"]


def _tree(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-]*)(\w+)", line)
        if m:
            out.append(m.group(1) + m.group(2))
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from vigil.plans.catalog import QUERIES
    from vigil.session import checkpoint_dir, get_session
    spark = get_session("local[8]", shuffle_partitions=16, app="plan-report")
    checkpoint_dir(spark)
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tests/plan_report.py` on `{sf}` (before AQE re-planning).", "",
             "| query | exchanges | sorts | window ops | scans | joins |",
             "| --- | --- | --- | --- | --- | --- |"]
    trees = []
    for n in HEADLINE:
        plan = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", plan))
        so = len(re.findall(r"\bSort \[", plan))
        wi = plan.count("Window [")
        sc = plan.count("FileScan")
        jo = len(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan))
        lines.append(f"| `{n}` | {ex} | {so} | {wi} | {sc} | {jo} |")
        trees += ["", f"## {n}", "", "```", _tree(plan), "```"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(lines + trees) + "\n")


if __name__ == "__main__":
    main()
