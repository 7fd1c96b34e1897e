"""Write PLANS.md: for every registered query, the physical operators that
matter at scale (exchanges, joins, windows, expands, top-k, generators,
subqueries) and the columns each Parquet scan reads.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quietude.plans.catalog import QUERIES  # noqa: E402
from quietude.session import get_session  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Expand", "TakeOrderedAndProject",
       "Generate", "Subquery", "ObjectHashAggregate", "SortAggregate"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{os.path.basename(sf)}` (plan before AQE re-optimisation).")
    print("Counts of the operators that decide cost at scale, and what each Parquet scan reads.\n")
    print("| query | operators | scans read |")
    print("|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = {op: len(re.findall(re.escape(op), plan)) for op in OPS}
        ops = ", ".join(f"{k} ×{v}" for k, v in counts.items() if v) or "none (map-only)"
        scans = "; ".join(sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))) or "-"
        print(f"| `{name}` | {ops} | {scans.replace('|', '/')} |")


if __name__ == "__main__":
    main()
