"""The radius join against its brute-force twin, in Spark.

Same inputs and answer, one warm-up and one timed run each; prints one JSON line.
BENCH_SF_DIR (default /root/testdata/sf0.01) and BENCH_CPUS as in bench.py. The twin
compares every pair within a country, so keep to small scale factors.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bench import start
from placelens.functions.geometry import Disc
from placelens.operators.radius import count_within
from placelens.operators.selection import feature_points, keyword_features
from testbed import adapters as t


def nested_loop(base: DataFrame, facilities: DataFrame, disc: Disc) -> DataFrame:
    inside = disc.contains(
        F.col("b.longitude"), F.col("b.latitude"), F.col("f.longitude"), F.col("f.latitude")
    )
    on = (F.col("b.country_code") == F.col("f.country_code")) & inside
    pairs = base.alias("b").join(facilities.alias("f"), on, "left")
    keys = [F.col(f"b.{c}").alias(c) for c in base.columns]
    return pairs.groupBy(*keys).agg(F.count("f.country_code").alias("n_within"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark = start(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    places, codes = t.places(spark, sf_dir), t.feature_codes(spark, sf_dir)
    columns = ["country_code", "longitude", "latitude"]
    base = feature_points(places, keyword_features(codes, t.SCHOOL)).select(*columns).distinct()
    near = feature_points(places, keyword_features(codes, t.HEALTH)).select(*columns)
    result: dict = {"metric": "warm seconds", "unit": "sec", "sf": sf_dir.rsplit("sf", 1)[-1]}
    for name, build in [
        ("boxes", lambda: count_within(base, near, 2.0)),
        ("nested_loop", lambda: nested_loop(base, near, Disc("polygon_deg", 2.0))),
    ]:
        for _ in range(2):
            begin = time.perf_counter()
            total = build().agg(F.sum("n_within")).first()[0]
            result[name] = round(time.perf_counter() - begin, 3)
        result[f"{name}_total"] = total
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
