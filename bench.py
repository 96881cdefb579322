"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, median taken
after one warm-up run), BENCH_QUERIES (comma-separated names instead of the headline ones).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from workload.adapter import CONFIG, Supplied
from workload.registry import CASES
from workload.single_step import single_step_flags
from basketlens.operators.fact import wide_fact

HEADLINE = (
    "customer_features",
    "customer_features_newest_load",
    "wide_fact",
    "basket_stats",
    "conditional_distinct",
    "latest_by_key",
    "duplicate_keys",
    "mart_customers",
    "mart_purchases",
    "mart_address",
    "mask_nested",
    "flatten_struct",
    "monthly_partition_write",
    "report_from_raw",
    "csv_export",
    "mv_incremental",
    "stream_ingest",
    "stream_route",
)


def materialize(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    supplied = Supplied(spark, folder)
    known = {case.name: case.run for case in CASES}
    known["single_step"] = lambda s: single_step_flags(wide_fact(**s.marts()), CONFIG)
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            materialize(known[name](supplied))
            taken.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
