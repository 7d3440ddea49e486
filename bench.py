"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one untimed run; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [name for name in QUERIES if name.startswith(("gd_", "sv_aggregated"))] + [
    "q_region_spent",
    "q_payment_v1",
    "q_payment_v3",
    "agg_multi_distinct",
    "join_left_chain_fanout",
    "sort_topk",
]


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    """Plan and compute every row of the result, without storing it."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # no Python stack traces attached to every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    times = {}
    for name in only:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
