"""Benchmark the headline queries.

Runs each query (plan construction included) on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up, then the
median of ``$BENCH_REPS`` (default 5) runs into the ``noop`` sink. Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "tariff_by_cost_centre",
    "anomaly_one_period",
    "anomaly_all_periods",
    "dense_sales_share",
    "rate_fill",
    "labor_allocation",
    "fill_down",
    "store_costs",
    "dc_costs",
    "accounts_by_store",
    "meter_rollup",
    "dq_report",
    "replace_period",
    "dense_sales_share_year",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = sys.argv[1:] or HEADLINE

    from ledgerloom.session import get_spark
    from ledgerloom.plans.bindings import QUERIES

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    results, failed = {}, {}
    for name in names:
        q = QUERIES[name]

        def run():
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            run()  # warm-up
            results[name] = round(statistics.median(run() for _ in range(reps)), 4)
        except Exception as ex:  # keep measuring the others; report the failure
            failed[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 4),
        "failed": failed,
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": cpus, "reps": reps,
                   "sink": "noop", "warmup": 1},
    }))


if __name__ == "__main__":
    main()
