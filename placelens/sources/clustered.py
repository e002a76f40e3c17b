"""Places as Parquet in the order of a space-filling curve, so that a scan of a region reads few row groups.

Longitude and latitude become a Z-order key; files are ranges of it and are sorted by it. Places of one region then
share files and row groups, whose smallest and largest coordinates let Parquet skip all others under plain
comparisons of longitude and latitude.

Edge cases: places without a finite place go behind all others; equal places are dealt over ranges by their other
columns, so one hot place fills no task; an empty table gives an empty one; all columns are kept.
"""

from __future__ import annotations

from functools import reduce
from math import asin, cos, degrees, radians, sin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens import schemas
from placelens.functions.geometry import Disc
from placelens.operators.radius import SLACK
from placelens.plans.joins import free_names

#: Bits of each coordinate in the key: boxes of 360 / 2^24 by 180 / 2^24 degrees.
BITS = 24
ROW_GROUP_BYTES = 32 * 1024 * 1024


def z_order(lon: Column, lat: Column, bits: int = BITS) -> Column:
    """The bits of both coordinates in turn, longitude first; null where one is null, NaN, infinite or off the globe.

    Points in one box of the grid share a key, and the four quarters of a box follow each other.
    """

    def spread(value: Column, low: float, width: float) -> Column:
        scaled = F.floor((value - low) / width * (1 << bits))
        number = F.least(scaled, F.lit((1 << bits) - 1)).cast("bigint")
        picked = [F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)), 2 * i) for i in range(bits)]
        return reduce(lambda a, b: a.bitwiseOR(b), picked)

    there = lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0)
    key = F.shiftleft(spread(lon, -180.0, 360.0), 1).bitwiseOR(spread(lat, -90.0, 180.0))
    return F.when(there, key)


def write_clustered(
    places: DataFrame,
    path: str,
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    mode: str = "overwrite",
) -> None:
    """Write ``places`` as ranges of the curve, sorted inside; ``files`` ranges or as many as shuffle partitions.

    Ranges come from Spark's sample of the keys, so dense regions get as many files as they need.
    """
    (key,) = free_names(["_curve"], places)
    lon, lat = F.col("longitude").cast("double"), F.col("latitude").cast("double")
    plain = [c for c, t in places.dtypes if not t.startswith(("map", "variant"))]
    # Equal keys are told apart by a hash of the row, so ranges can divide them.
    order = [F.col(key).asc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in plain])]
    keyed = places.withColumn(key, z_order(lon, lat))
    ranged = keyed.repartitionByRange(*([files] if files else []), *order)
    ranged.sortWithinPartitions(*order).drop(key).write.mode(mode).option(
        "parquet.block.size", row_group_bytes
    ).parquet(path)


def read_clustered(spark: SparkSession, path: str, with_country: bool = False) -> DataFrame:
    """The places of :func:`write_clustered`."""
    return spark.read.schema(schemas.ENRICHED_PLACES if with_country else schemas.CLEAN_PLACES).parquet(path)


def in_box(places: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Places in a box, its rim included; a box whose west is greater than its east crosses the date line."""
    lon, lat = F.col("longitude"), F.col("latitude")
    across = lon.between(west, east) if west <= east else lon.between(west, 180.0) | lon.between(-180.0, east)
    return places.where(across & lat.between(south, north))


def near_point(places: DataFrame, lon: float, lat: float, radius: float, metric: str = "km") -> DataFrame:
    """Places strictly inside the disc around a point, read through the box around the disc.

    ``metric`` as in the radius join. In km the box takes in the pole and all longitudes where the disc does.
    """
    disc = Disc(metric, radius)
    inside = disc.contains(F.lit(float(lon)), F.lit(float(lat)), F.col("longitude"), F.col("latitude"))
    return in_box(places, *_box(disc, lon, lat)).where(inside)


def _box(disc: Disc, lon: float, lat: float) -> tuple[float, float, float, float]:
    if disc.metric != "km":
        reach = disc.radius * (1 + SLACK)
        return lon - reach, lat - reach, lon + reach, lat + reach
    angle = 2 * asin(min(1.0, disc.reach / 2)) * (1 + SLACK) + SLACK
    south, north = lat - degrees(angle), lat + degrees(angle)
    if south <= -90 or north >= 90:
        return -180.0, south, 180.0, north
    side = degrees(asin(min(1.0, sin(angle) / cos(radians(lat))))) + SLACK
    west, east = lon - side, lon + side
    if side >= 180:
        return -180.0, south, 180.0, north
    return (west + 360 if west < -180 else west), south, (east - 360 if east > 180 else east), north
