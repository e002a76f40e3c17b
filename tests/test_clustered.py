"""Places along a space-filling curve: the key, what a scan of a region reads, brute-force twins."""

import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from placelens import schemas
from placelens.functions.geometry import Disc
from placelens.sources import clustered
from tests.conftest import rows

FIELDS = [f.split()[0] for f in schemas.CLEAN_PLACES.split(", ")]


def places(spark, at):
    data = spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "geonameid BIGINT, longitude DOUBLE, latitude DOUBLE")
    kinds = dict(f.split() for f in schemas.CLEAN_PLACES.split(", "))
    return data.select(*[f if f in data.columns else F.lit(None).cast(kinds[f]).alias(f) for f in FIELDS])


def globe(n, seed=3):
    r = random.Random(seed)
    return [(r.uniform(-180, 180), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]


def interleaved(lon, lat, bits):
    x = min(math.floor((lon + 180) / 360 * 2**bits), 2**bits - 1)
    y = min(math.floor((lat + 90) / 180 * 2**bits), 2**bits - 1)
    both = (f"{a}{b}" for a, b in zip(f"{x:0{bits}b}", f"{y:0{bits}b}"))
    return int("".join(both), 2)


def test_key_is_the_interleaved_bits(spark):
    at = [*globe(50), (-180.0, -90.0), (180.0, 90.0), (0.0, 0.0)]
    df = spark.createDataFrame(at, "lon DOUBLE, lat DOUBLE")
    for bits in (3, clustered.BITS):
        got = df.select("lon", "lat", clustered.z_order(F.col("lon"), F.col("lat"), bits).alias("z")).collect()
        assert [r.z for r in got] == [interleaved(r.lon, r.lat, bits) for r in got]
    odd = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (float("inf"), 1.0), (1.0, 91.0)]
    odd = spark.createDataFrame(odd, df.schema)
    assert odd.select(clustered.z_order(F.col("lon"), F.col("lat")).alias("z")).where("z IS NOT NULL").isEmpty()


def read_by_scan(df):
    """Rows that the Parquet scans of an executed plan gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_region_reads_few_rows(spark, tmp_path):
    n, path = 40_000, str(tmp_path / "places")
    df = places(spark, globe(n))
    clustered.write_clustered(df, path, files=16, row_group_bytes=16 * 1024)
    back = clustered.read_clustered(spark, path)
    assert rows(back) == rows(df)
    region = clustered.in_box(back, 10.0, 10.0, 20.0, 20.0).select("geonameid")
    near = clustered.near_point(back, 10.0, 50.0, 300.0).select("geonameid")
    assert rows(region) == rows(df.where("longitude BETWEEN 10 AND 20 AND latitude BETWEEN 10 AND 20").select("geonameid"))
    for found in (region, near):
        assert 0 < found.count() <= read_by_scan(found) < n / 8
    df.write.parquet(str(tmp_path / "plain"))
    assert read_by_scan(clustered.in_box(spark.read.parquet(str(tmp_path / "plain")), 10.0, 10.0, 20.0, 20.0)) > n / 2


@pytest.mark.parametrize("lon, lat", [(0.0, 0.0), (179.5, 10.0), (-179.9, -40.0), (30.0, 89.5), (-20.0, -88.0), (100.0, 75.0)])
def test_near_point_is_the_disc(spark, lon, lat):
    r = random.Random(8)
    close = [((lon + r.gauss(0, 30) + 540) % 360 - 180, max(-90.0, min(90.0, lat + r.gauss(0, 8)))) for _ in range(400)]
    df = places(spark, [*globe(400), *close, (180.0, 0.0), (-180.0, 0.0), (0.0, 90.0)])
    for metric, radius in (("km", 900.0), ("km", 30.0), ("polygon_deg", 4.0), ("circle_deg", 4.0)):
        inside = Disc(metric, radius).contains(F.lit(lon), F.lit(lat), F.col("longitude"), F.col("latitude"))
        got = clustered.near_point(df, lon, lat, radius, metric)
        assert rows(got, "geonameid") == rows(df.where(inside), "geonameid")


def test_hot_place_odd_places_and_clashing_columns(spark, tmp_path):
    hot = places(spark, [(1.0, 1.0)] * 2000 + globe(500))
    odd = places(spark, [(None, None), (float("nan"), 2.0), (500.0, 2.0)])
    df = hot.unionByName(odd).withColumn("_curve", F.lit("own")).withColumn("some.name", F.lit(1))
    path = str(tmp_path / "hot")
    clustered.write_clustered(df, path, files=8)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and repr(rows(back)) == repr(rows(df))
    sizes = [pq.read_metadata(f).num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert len(sizes) == 8 and max(sizes) < 800
    clustered.write_clustered(df.limit(0), str(tmp_path / "none"))
    assert clustered.read_clustered(spark, str(tmp_path / "none")).isEmpty()
