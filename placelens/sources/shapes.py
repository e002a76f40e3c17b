"""Country outlines from GeoJSON.

A feature collection is cut at its feature marks by the text reader, which splits files, so one large file is read by
several tasks and no task holds more than a feature at a time. Newline-delimited features are read line by line.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.schemas import POLYGONS

FEATURE = "properties STRUCT<geoNameId: STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"
# Names under which longitude/latitude degrees on WGS84 are declared.
LONLAT_CRS = ["EPSG:4326", "urn:ogc:def:crs:EPSG::4326", "urn:ogc:def:crs:OGC:1.3:CRS84"]
# Names of spherical (web) Mercator, in metres.
MERCATOR_CRS = ["EPSG:3857", "EPSG:900913", "urn:ogc:def:crs:EPSG::3857"]
MERCATOR_RADIUS = 6378137.0
MARK = '"Feature"'
NAMED_CRS = r'(?s)"crs"\s*:\s*\{\s*"type"\s*:\s*"name"\s*,\s*"properties"\s*:\s*\{\s*"name"\s*:\s*"([^"]*)"'


def read_shapes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``geoNameId`` (string key as stored) and ``polygons`` of every feature, in longitude and latitude.

    lines: each line is a feature. Otherwise each file is a feature collection whose features begin with their type.
    A Polygon becomes a MultiPolygon of one; features of other kinds are left out. Web Mercator is turned into degrees; a file
    that declares another reference system fails, and so does a feature that can't be read.
    """
    text = spark.read.text(path) if lines else spark.read.option("lineSep", MARK).text(path)
    text = text.select("value", F.col("_metadata.file_path").alias("file"))
    if lines:
        body, outside = F.when(F.trim("value") != "", F.col("value")), F.lit(False)
    else:
        # Behind a mark stand the feature's other members, which close it. What follows, the beginning of the next
        # feature or the collection's end, is no part of the first JSON value, and the parser leaves it.
        head = F.ltrim("value").startswith("{")
        body = F.when(~head, F.concat(F.lit('{"type":"Feature"'), "value"))
        outside = head | F.col("value").rlike(r"\}\s*$")
    named = F.regexp_extract("value", NAMED_CRS, 1)
    systems = text.where(outside).select(F.col("file").alias("of"), named.alias("crs")).where("crs <> ''").distinct()
    read = text.select("file", body.alias("body")).where("body IS NOT NULL")
    read = read.withColumn("f", F.from_json("body", f"{FEATURE}, bad STRING", {"columnNameOfCorruptRecord": "bad"}))
    # One row at most for each file that declares a system: the driver lists the files anyway.
    found = read.join(F.broadcast(systems), read.file == systems.of, "left")
    unread = F.raise_error(F.concat(F.lit("unreadable feature "), F.substring("body", 1, 80))).cast(POLYGONS)
    kind, coordinates = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one = F.array(F.from_json(coordinates, "ARRAY<ARRAY<ARRAY<DOUBLE>>>"))
    polygons = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.from_json(coordinates, POLYGONS))
    return found.select(
        F.col("f.properties.geoNameId").alias("geoNameId"),
        F.when(F.col("f").isNull() | F.col("f.bad").isNotNull(), unread).otherwise(_in_degrees(polygons, F.col("crs"))).alias("polygons"),
    ).filter("polygons IS NOT NULL")


def mercator_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of web Mercator metres."""
    return x / MERCATOR_RADIUS * (180 / pi), (2 * F.atan(F.exp(y / MERCATOR_RADIUS)) - pi / 2) * (180 / pi)


def degrees_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Web Mercator metres of longitude and latitude."""
    return F.radians(lon) * MERCATOR_RADIUS, F.log(F.tan(pi / 4 + F.radians(lat) / 2)) * MERCATOR_RADIUS


def _in_degrees(polygons: Column, crs: Column) -> Column:
    def position(p: Column) -> Column:
        return F.array(*mercator_to_degrees(F.get(p, F.lit(0)), F.get(p, F.lit(1))))

    turned = F.transform(polygons, lambda rings: F.transform(rings, lambda ring: F.transform(ring, position)))
    name = F.upper(crs)
    return (
        F.when(crs.isNull() | name.isin([c.upper() for c in LONLAT_CRS]), polygons)
        .when(name.isin([c.upper() for c in MERCATOR_CRS]), turned)
        .otherwise(F.raise_error(F.concat(F.lit("unsupported reference system "), crs)).cast(POLYGONS))
    )


def keyed_shapes(shapes: DataFrame) -> DataFrame:
    """Shapes with the key renamed and cast to join with ``geonameid``."""
    return shapes.withColumnRenamed("geoNameId", "geonameid").withColumn(
        "geonameid", F.col("geonameid").cast("bigint")
    )
