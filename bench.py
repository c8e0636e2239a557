"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores. Each query is
run once to warm up and then BENCH_RUNS times (default 2); the best time counts. A run
includes all that the query writes, and ends with every result row being produced.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from asterloom.plans.queries import QUERIES

HEADLINE = [
    "clean",
    "explode_bridge",
    "dim_date",
    "dim_entity",
    "fact",
    "fact_from_arrays",
    "left_join",
    "new_rows",
    "append_first",
    "append_second",
    "append_second_shuffled",
    "page_window_popularity",
    "flatten_pages",
    "quality_counts",
    "json_round_trip",
    "star_pipeline",
    "metrics_by_category",
    "metrics_by_month",
    "top_entities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(min(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
