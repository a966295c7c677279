"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Each query is
run once to warm up and then BENCH_RUNS times; the fastest run counts. A run
covers planning, execution and delivery of all rows and columns. The queries
with joins are then run once more without automatic broadcasts, as their plans
are on large tables; those times are listed apart and not in the total.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from martloom.catalogue.queries import all_queries
from martloom.session import local_session

HEADLINES = [
    "sales_mart_daily",
    "sales_mart_view",
    "sales_report",
    "plan_fact_mart",
    "plan_fact_view",
    "plan_fact_report",
    "load_coupons_dds",
    "load_bills_dds",
    "delta_partition_load",
    "dict_lookup",
    "union_all_filters",
    "or_filter_join",
    "distinct_then_join",
    "year_trunc_sum",
    "year_range_sum",
    "pipeline_run",
]


# Queries whose joins are shuffled at scale.
SHUFFLED = [
    "sales_mart_daily",
    "plan_fact_mart",
    "plan_fact_report",
    "load_coupons_dds",
    "load_bills_dds",
    "dict_lookup",
    "or_filter_join",
]


def timed(run: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    queries = all_queries()
    times = {}
    for name in HEADLINES:
        best = float("inf")
        for run in range(runs + 1):
            took = timed(lambda: queries[name](spark, folder))
            if run:
                best = min(best, took)
        times[name] = round(best, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = {name: round(timed(lambda: queries[name](spark, folder)), 3) for name in SHUFFLED}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "queries_without_broadcast": shuffled,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
