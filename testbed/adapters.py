"""Place-shaped tables built from the driver tables (definitions in FIXTURES.md).

They are joins and aggregates over whole tables, so every query on them grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelens import schemas

HEALTH = {"short_description": ["gear", "ring"], "long_description": ["gear", "ring"]}
SCHOOL = {"short_description": ["bolt", "rod"]}
SUFFIXES = (["short_description", "long_description"], ["gear", "ring"])


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once, not for every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def class_letter(p_type: Column) -> Column:
    """One class letter for each of the six part types."""
    return F.when(p_type == "STANDARD", "V").otherwise(
        F.translate(F.substring(p_type, 1, 1), "EM", "HT")
    )


def _corner(nation: Column) -> tuple[Column, Column]:
    return (
        F.lit(-100.0) + (nation % 5).cast("double") * 40.0,
        F.lit(-60.0) + F.floor(nation / 5).cast("double") * 25.0,
    )


def _offset(key: Column, multiplier: int) -> Column:
    return ((key.cast("bigint") * multiplier) % 10000).cast("double") / 1000.0 + 0.0005


def _longitude(nation: Column, key: Column, multiplier: int) -> Column:
    return _corner(nation)[0] + _offset(key, multiplier)


def _latitude(nation: Column, key: Column, multiplier: int) -> Column:
    return _corner(nation)[1] + _offset(key, multiplier)


def feature_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy(class_letter(F.col("p_type")).alias("feature_class"), F.col("p_brand").alias("feature_code"))
        .agg(F.min("p_name").alias("short_description"), F.max("p_name").alias("long_description"))
    )


def country_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("country_code"), F.col("n_name").alias("country")
    )


def country_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    people = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("people"))
    other = nation.select(F.col("n_regionkey"), F.col("n_nationkey").cast("string").alias("other"))
    listed = (
        nation.filter("n_regionkey <> 4")
        .join(other, "n_regionkey")
        .filter(F.col("other") != F.col("n_nationkey").cast("string"))
        .groupBy("n_nationkey")
        .agg(F.array_join(F.sort_array(F.collect_list("other")), ",").alias("listed"))
    )
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        nation.join(region, "n_regionkey")
        .join(people, nation["n_nationkey"] == people["c_nationkey"], "left")
        .join(listed, "n_nationkey", "left")
        .select(
            F.col("n_name").alias("country"),
            F.concat(F.lit("CAPITAL_"), F.col("n_nationkey").cast("string")).alias("capital"),
            (F.lit(1000) + F.col("n_nationkey") * 10).cast("bigint").alias("area_sq_km"),
            (F.lit(1000000) + F.coalesce("people", F.lit(0)) * 1000).cast("bigint").alias("population"),
            F.col("r_name").alias("continent"),
            F.col("n_nationkey").cast("bigint").alias("geonameid"),
            F.coalesce("listed", F.lit("")).alias("neighbours"),
        )
    )


def _located_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    return items.join(part, items["l_partkey"] == part["p_partkey"]).join(
        supplier, items["l_suppkey"] == supplier["s_suppkey"]
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11 columns of a clean place table: one row per nation and one per lineitem."""
    n = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        n.cast("bigint").alias("geonameid"),
        F.col("n_name").alias("name"),
        _latitude(n, n, 1).alias("latitude"),
        _longitude(n, n, 1).alias("longitude"),
        F.lit("A").alias("feature_class"),
        F.lit("PCLI").alias("feature_code"),
        n.cast("string").alias("country_code"),
        F.lit(0).cast("bigint").alias("population"),
        F.lit(None).cast("int").alias("elevation"),
        F.lit("UTC").alias("timezone"),
        F.lit("2020-01-01").cast("date").alias("modification_date"),
    )
    s = F.col("s_nationkey")
    items = _located_items(spark, sf_dir).select(
        (F.lit(1000) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("geonameid"),
        F.col("p_name").alias("name"),
        _latitude(s, F.col("l_partkey"), 104729).alias("latitude"),
        _longitude(s, F.col("l_orderkey"), 7919).alias("longitude"),
        class_letter(F.col("p_type")).alias("feature_class"),
        F.col("p_brand").alias("feature_code"),
        s.cast("string").alias("country_code"),
        F.col("l_quantity").cast("bigint").alias("population"),
        F.col("p_size").cast("int").alias("elevation"),
        F.lit("UTC").alias("timezone"),
        F.col("l_shipdate").cast("date").alias("modification_date"),
    )
    return nations.unionByName(items)


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 raw columns, one row per lineitem, with gaps for cleaning to fill.

    Longitude is NaN on line 1 and latitude null on line 2; returned items lack name and
    population, others the timezone; elevation is null where the part size is above 40.
    """
    line, returned = F.col("l_linenumber"), F.col("l_returnflag") == "R"
    s = F.col("s_nationkey")
    values = {
        "geonameid": (F.lit(1000) + F.col("l_orderkey") * 8 + line).cast("bigint"),
        "name": F.when(~returned, F.col("p_name")),
        "ascii_name": F.col("p_name"),
        "alternate_names": F.concat_ws(",", "p_name", "s_name"),
        "latitude": F.when(line != 2, _latitude(s, F.col("l_partkey"), 104729)),
        "longitude": F.when(line == 1, F.lit(float("nan"))).otherwise(
            _longitude(s, F.col("l_orderkey"), 7919)
        ),
        "feature_class": class_letter(F.col("p_type")),
        "feature_code": F.col("p_brand"),
        "country_code": s.cast("string"),
        "cc2": F.lit(""),
        "admin1_code": F.col("l_linestatus"),
        "admin2_code": F.lit(""),
        "admin3_code": F.lit(""),
        "admin4_code": F.lit(""),
        "population": F.when(~returned, F.col("l_quantity").cast("bigint")),
        "elevation": F.when(F.col("p_size") <= 40, F.col("p_size").cast("int")),
        "dem": F.lit(""),
        "timezone": F.when(returned, F.lit("UTC")),
        "modification_date": F.col("l_shipdate").cast("date"),
    }
    return _located_items(spark, sf_dir).select(*[c.alias(name) for name, c in values.items()])


def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(schemas.CLASS_NAME_ROWS, schemas.CLASS_NAMES)


def _keyed_points(
    df: DataFrame, key: str, nation: str, lon_multiplier: int, lat_multiplier: int
) -> DataFrame:
    k, n = F.col(key), F.col(nation)
    return df.select(
        k.cast("bigint").alias("id"),
        n.cast("string").alias("country_code"),
        _longitude(n, k, lon_multiplier).alias("longitude"),
        _latitude(n, k, lat_multiplier).alias("latitude"),
    )


def base_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_points(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey", 7919, 104729)


def facility_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_points(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey", 6007, 3001)


def country_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 10 x 10 degree box per nation with a 2 x 2 hole, keyed like a shape file."""
    n = F.col("n_nationkey")
    x, y = _corner(n)

    def box(low: float, high: float) -> Column:
        corners = [(low, low), (high, low), (high, high), (low, high), (low, low)]
        return F.array(*[F.array(x + dx, y + dy) for dx, dy in corners])

    return table(spark, sf_dir, "nation").select(
        n.cast("string").alias("geoNameId"),
        F.array(F.array(box(0.0, 10.0), box(4.0, 6.0))).alias("polygons"),
    )
