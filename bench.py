"""Headline-query benchmark.

Runs the weekly forecast job and the daily replenishment job stage by stage on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and
prints one JSON line.  Every query is executed in full through the ``noop`` sink
(no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "weekly_segment_sales",      # H1
    "demand_features",           # H2
    "forecast_12w",              # H3 (GBT, prod size)
    "breakdown_to_store",        # H4
    "weekly_to_daily",           # H5
    "safety_stock_weighted",     # H8a
    "variant_weight_map",        # H6
    "replenishment_need_prod",   # J8 + H8
    "warehouse_distribution",    # H9 (dense contention fixture)
    "publish_distribution",      # need -> allocation, SKU level
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "4")
    keys = sys.argv[1:] or HEADLINE
    from shelfcast.session import build_session
    from shelfcast.plans.catalog import QUERIES
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "6g")})
    # JIT/codegen warm-up on a different query (not timed): the first job in a fresh JVM
    # pays class loading and code generation that a long-running cluster has paid already
    QUERIES["weekly_quantity"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
