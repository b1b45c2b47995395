"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Every query is fully executed (noop sink: all rows computed, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakemart.plans.catalog import QUERIES  # noqa: E402
from lakemart.session import get_spark  # noqa: E402

HEADLINE = [
    "fact_sales", "payments_aggregated", "dim_geolocation", "dim_customer", "dim_product",
    "dim_date", "stg_orders", "stg_order_items", "stg_customers", "stg_reviews",
    "dedupe_latest", "incremental_filter", "incremental_merge", "schema_sync",
    "scd2_snapshot", "scd2_as_of", "data_tests_summary", "test_unique_combo", "hash_sample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [q for q in HEADLINE if q in QUERIES] + \
        [q for q in QUERIES if q not in HEADLINE]
    spark = get_spark("lakemart-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      **{"spark__driver__memory": "16g"})
    # warm-up pass (not timed): every query once on the smallest tables, so JVM
    # class loading and whole-stage code generation are done before timing
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    w0 = time.perf_counter()
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - w0, 3)
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "warmup_sec": warmup}))


if __name__ == "__main__":
    main()
