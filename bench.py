"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_REPS`` (default 5) timed runs
into the ``noop`` sink (full execution, no driver collection); the median is
reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "load_filtered",
    "filter_reject_reasons",
    "country_counts",
    "select_top_countries",
    "filter_supported_bins",
    "flag_discrepancies",
    "discrepancy_severity",
    "distinct_support",
    "stage_metrics",
    "snapshot_read_all",
    "snapshot_drift",
    "publish_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master(f"local[{cpus}]")
               .appName("cardgeo-bench")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", str(cpus))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        # One machine; a cluster names a folder that its executors share.
        builder = builder.config("spark.checkpoint.dir",
                                 os.environ.get("BENCH_SHARED_DIR", "/tmp/cardgeo-bench-shared"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from cardgeo.plans.queries import QUERIES

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up
        results[name] = round(statistics.median(run(name) for _ in range(reps)), 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
