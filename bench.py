"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_REPEAT   timed runs per query, the best counts (default 1, after one warm-up of the session)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.driver_queries import QUERIES  # noqa: E402
from tidemark.session import with_settings  # noqa: E402

HEADLINE = (
    "bronze_valid",
    "bronze_rejected",
    "silver_dedup_masked",
    "gold_fraud_alerts",
    "gold_hourly_liquidity",
    "gold_alerts_backfill",
    "gold_liquidity_backfill",
    "gold_liquidity_lookback",
    "gold_alerts_incremental",
    "gold_liquidity_incremental",
    "merge_new_column",
    "partition_hour_comparisons",
    "dq_summary",
    "stream_silver",
    "stream_medallion_counts",
    "compact_silver",
    "compact_gold",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    only = sys.argv[1:] or HEADLINE
    spark = (
        with_settings(SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench"), cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("gold_hourly_liquidity")
    seconds = {name: round(min(run(name) for _ in range(repeat)), 3) for name in only}
    result = {
        "metric": "total seconds over the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
