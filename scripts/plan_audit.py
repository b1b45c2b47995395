"""Plan audit: physical plan shape of every registered query.

Usage: python scripts/plan_audit.py [sf_dir]
Prints per query the number of exchanges, broadcasts, sort-merge and broadcast
hash joins, scans with pushed filters, and flags nested-loop / cartesian joins
and Python evaluation (none are expected).  Queries that write tables are
skipped (their plans are the fact build plus file writes).
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.plans.catalog import QUERIES  # noqa: E402
from lakemart.session import get_spark  # noqa: E402

FLAGS = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")
WRITERS = {"incremental_merge", "schema_sync", "load_report", "incremental_load", "full_reload"}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    for name, fn in QUERIES.items():
        if name in WRITERS:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        exchanges = sum(plan.count(f"Exchange {k}") for k in ("hashpartitioning", "rangepartitioning",
                                                               "RoundRobin", "SinglePartition"))
        print(f"{name:26s} exch={exchanges:3d} bcast={plan.count('BroadcastExchange'):2d} "
              f"smj={plan.count('SortMergeJoin'):2d} bhj={plan.count('BroadcastHashJoin'):2d} "
              f"pushedScans={len(re.findall(r'PushedFilters: \[[^\]]+\]', plan)):2d} "
              + " ".join(f for f in FLAGS if f in plan), flush=True)


if __name__ == "__main__":
    main()
