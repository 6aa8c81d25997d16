"""Times the catalogue's headline queries and the warehouse build; prints one JSON line.

BENCH_SF_DIR   folder of driver tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)

Each query runs once unmeasured and then twice (long ones once); the mean counts. Results go to Spark's
no-op sink, so a whole result is computed but not moved to Python. Queries over the mart read
tables built once per session; building them from the source tables is timed as ``mart_build``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue.queries import CATALOGUE, SELLERS_EFFECTIVE  # noqa: E402
from martloom.plans.mart import Mart  # noqa: E402
from martloom.session import configure, folder_bytes, size_shuffles  # noqa: E402
from martloom.sources.driver_tables import driver_feeds  # noqa: E402

HEADLINE = [
    "load_counts",
    "profile_grain",
    "profile_composite_key",
    "profile_nulls",
    "profile_price_ranges",
    "orphan_counts",
    "scd2_merge",
    "fact_order_items",
    "fact_payments",
    "fact_delivery_reviews",
    "fact_order_items_keyed",
    "unknown_routing",
    "freight_overall",
    "freight_by_category",
    "freight_by_state",
    "items_per_order",
    "repeat_customers",
    "monthly_trend",
    "payments_by_type",
    "score_by_late",
    "score_by_delay_bucket",
    "rfm_base",
    "rfm_scores",
    "rfm_segments",
    "segment_spend",
    "segment_satisfaction",
    "dq_checks",
    "final_validation",
    "incremental_expected",
    "incremental_loaded",
    "incremental_stream",
    "csv_text_load",
]
RUNS = 2
LONG = 8.0  # seconds; longer ones are measured once


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    size_shuffles(spark, folder_bytes(spark, sf_dir))

    def build() -> None:
        Mart(spark, driver_feeds(spark, sf_dir), SELLERS_EFFECTIVE).build_all()

    def run(name: str) -> None:
        CATALOGUE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def measure(action) -> float:
        first = timed(action)
        runs = 1 if first > LONG else RUNS
        return round(statistics.mean(timed(action) for _ in range(runs)), 4)

    seconds = {"mart_build": measure(build)}
    for name in HEADLINE:
        seconds[name] = measure(lambda: run(name))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
