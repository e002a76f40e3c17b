"""Readers for place tables and dimensions. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens import schemas


def read_raw_places(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated dump, plain or gzip. A ``"`` is an ordinary character in it."""
    return (
        spark.read.schema(schemas.RAW_PLACES)
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )


BAD_LINE = "bad_line"


def read_checked(spark: SparkSession, path: str, schema: str = schemas.RAW_PLACES, raw: bool = True) -> DataFrame:
    """Rows of text files with ``bad_line``, null where the line fits the schema, and the ``file``.

    A line fits if it has as many fields as the schema, each empty or of its type, whichever columns are asked for later. raw:
    a tab-separated dump in which quotes are ordinary; else a headerless CSV table, such as the dimensions, with a row
    on each line. Blank lines are no rows.
    """
    lines = spark.read.text(path).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    options = {"sep": "\t", "quote": ""} if raw else {}
    parsed = F.from_csv("value", f"{schema}, {BAD_LINE} STRING", options | {"columnNameOfCorruptRecord": BAD_LINE})
    return lines.select(parsed.alias("row"), "file").select("row.*", "file")


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of :func:`read_checked` that fit, with the schema's columns."""
    return checked.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "file")


def bad_rows(checked: DataFrame) -> DataFrame:
    """File and line of the rows that don't fit."""
    return checked.where(F.col(BAD_LINE).isNotNull()).select("file", BAD_LINE)


def line_counts(checked: DataFrame) -> DataFrame:
    """For each file: how many lines it has, and how many of them don't fit."""
    return checked.groupBy("file").agg(F.count("*").alias("n_lines"), F.count(BAD_LINE).alias("n_bad"))


def read_places_csv(spark: SparkSession, path: str, with_country: bool = False) -> DataFrame:
    """Cleaned places as headerless CSV, with 11 or (enriched) 12 columns."""
    schema = schemas.ENRICHED_PLACES if with_country else schemas.CLEAN_PLACES
    return spark.read.schema(schema).csv(path)


def read_places(spark: SparkSession, path: str, with_country: bool = False) -> DataFrame:
    """Our own layout: Parquet, partitioned by country code.

    The schema is given, so that a folder name never turns a code into a number. An
    empty code is stored as the null partition and comes back as "" here.
    """
    schema = schemas.ENRICHED_PLACES if with_country else schemas.CLEAN_PLACES
    return spark.read.schema(schema).parquet(path).na.fill("", ["country_code"])


def read_feature_codes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FEATURE_CODES).csv(path)


def read_country_info(spark: SparkSession, path: str) -> DataFrame:
    """Country attributes. ``neighbours`` holds commas, so quoting stays on."""
    return spark.read.schema(schemas.COUNTRY_INFO).csv(path)


def read_country_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.COUNTRY_MAPPING).csv(path)


def read_class_distribution(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLASS_DISTRIBUTION).csv(path)


def class_names(spark: SparkSession) -> DataFrame:
    """The class letters and their descriptions, from rows written in the code."""
    return spark.createDataFrame(schemas.CLASS_NAME_ROWS, schemas.CLASS_NAMES)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables reachable from ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
