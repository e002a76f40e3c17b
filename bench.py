"""Time the headline queries on a warm local session; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (timed
runs after one warm-up, default 1; the median counts), BENCH_QUERIES (comma-separated,
default all headline queries).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from placelens.session import SETTINGS
from testbed.registry import queries

HEADLINE = [
    "places_scan",
    "clean_places",
    "page_links",
    "places_enriched",
    "code_counts",
    "facility_counts",
    "country_index_scaled",
    "country_index_log",
    "code_index_described",
    "neighbour_compare",
    "class_advice",
    "code_share",
    "suffix_places",
    "feature_points",
    "within_polygon_deg",
    "within_circle_deg",
    "within_km",
    "place_proximity",
    "points_in_country_shape",
    "places_in_own_shape",
    "density_grid",
    "place_density",
]


def start(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("placelens-bench")
    local = {
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(2 * int(cpus)),
        # One machine with little data: keep all cores busy after a shuffle.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "4m",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark, registered = start(cpus), queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median warm seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
