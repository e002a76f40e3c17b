"""Facilities per country and code, and the population each of them serves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelens.functions.scaling import log_shade, min_max, ratio
from placelens.operators.selection import CLASS_AND_CODE_KEY, CODE_KEY
from placelens.plans.joins import is_small, join_dimension

COUNTRY_COLUMNS = ["population", "area_sq_km", "geonameid", "neighbours"]


def code_counts(places: DataFrame) -> DataFrame:
    """Places per country and feature code."""
    return places.groupBy("country_code", "feature_code").agg(F.count("*").alias("n"))


def facility_counts(
    places: DataFrame,
    matched: DataFrame,
    info: DataFrame,
    keys: list[str] | None = None,
) -> DataFrame:
    """Places per country and matched code, with the attributes of the country.

    ``keys`` is the dictionary key: the code alone (a code listed under several classes
    then counts once for each) or class and code.

    The large table is read once. Its rows are tagged with the country whose own place
    they are, counted per code, and only those counts are looked at again to learn
    which country each code stands for.
    """
    keys = CODE_KEY if keys is None else keys
    if keys not in (CODE_KEY, CLASS_AND_CODE_KEY):
        raise ValueError(f"keys must be {CODE_KEY} or {CLASS_AND_CODE_KEY}")
    small = is_small(info)
    tagged = join_dimension(
        places.filter("country_code IS NOT NULL").select("geonameid", "country_code", *keys),
        info.select("geonameid", F.col("geonameid").alias("own_id")).distinct(),
        ["geonameid"],
        "left",
        small=small,
    )
    per_code = tagged.groupBy("country_code", *keys, "own_id").agg(F.count("*").alias("n"))

    # Bounded by countries x codes from here on.
    country = Window.partitionBy("country_code")
    same_code = Window.partitionBy("country_code", *keys)
    # An entry for each country id and code, however many place rows carry it.
    own = F.when(F.col("own_id").isNotNull(), F.struct("own_id", F.col("n").alias("times")))
    counts = (
        per_code.withColumn("own_ids", F.collect_list(own).over(country))
        .withColumn("first_of_code", F.row_number().over(same_code.orderBy(F.col("own_id").asc_nulls_first())))
        .withColumn("n", F.sum("n").over(same_code))
        .filter("first_of_code = 1")
        .select("country_code", *keys, "n", F.inline("own_ids").alias("geonameid", "times"))
        .select("country_code", *keys, "n", "geonameid", F.explode(F.expr("sequence(1L, times)")).alias("time"))
        .drop("time")
    )
    columns = [c for c in ("feature_class", "feature_code") if c in matched.columns]
    described = join_dimension(counts, matched.select(*columns), keys)
    attributes = info.select(*COUNTRY_COLUMNS)
    return join_dimension(described, attributes, ["geonameid"], small=small).select(
        "feature_code", "country_code", "n", "feature_class", *COUNTRY_COLUMNS
    )


def country_totals(facilities: DataFrame) -> DataFrame:
    """Facilities per country, once for each of its matched classes."""
    total = F.sum("n").over(Window.partitionBy("country_code"))
    return facilities.select(
        "feature_class", "country_code", total.alias("total"), *COUNTRY_COLUMNS
    ).distinct()


def country_index(totals: DataFrame) -> DataFrame:
    """Population per facility: a lower index is better."""
    return totals.withColumn("index_by_class", ratio(F.col("population"), F.col("total")))


def code_index(facilities: DataFrame) -> DataFrame:
    """Population per facility of each code."""
    return facilities.withColumn("index_by_code", ratio(F.col("population"), F.col("n")))


def code_index_described(index: DataFrame, codes: DataFrame) -> DataFrame:
    """Code index with every dictionary description of the code, joined on code alone."""
    described = codes.select(
        "feature_code",
        F.col("feature_class").alias("described_class"),
        "short_description",
        "long_description",
    )
    return join_dimension(index, described, CODE_KEY)


def _extremes(df: DataFrame, x: Column) -> Column:
    """One-row minimum and maximum of x as a scalar subquery: no driver round trip."""
    return df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("range")).scalar()


def country_index_scaled(index: DataFrame) -> DataFrame:
    """Index scaled to 0..1 over all countries; NULL when all are equal."""
    x = F.col("index_by_class")
    return (
        index.withColumn("_range", _extremes(index, x))
        .withColumn("scaled_index", min_max(x, F.col("_range.low"), F.col("_range.high")))
        .drop("_range")
    )


def country_index_log(scaled: DataFrame) -> DataFrame:
    """Shade of the map: log scale between the smallest and largest positive scaled index."""
    x = F.col("scaled_index")
    positive = F.when(x > 0, x)
    return (
        scaled.withColumn("_range", _extremes(scaled, positive))
        .withColumn("shade", log_shade(x, F.col("_range.low"), F.col("_range.high")))
        .drop("_range")
    )


def shapes_with_index(shapes: DataFrame, scaled: DataFrame) -> DataFrame:
    """Outlines of the countries that have an index."""
    return shapes.join(scaled, "geonameid")


def neighbour_compare(index: DataFrame, country_code: str | None = None) -> DataFrame:
    """Index of each country next to those of its neighbours.

    One row per (country, compared country, class), the country itself flagged by
    ``is_self``. Countries without neighbours give no rows. Works for all countries at
    once, or for one.
    """
    subjects = index if country_code is None else index.filter(F.col("country_code") == country_code)
    listed = F.filter(F.split("neighbours", ","), lambda c: c != "")
    pairs = (
        subjects.select("country_code", "neighbours")
        .distinct()
        .filter(F.size(listed) > 0)
        .select(
            F.col("country_code").alias("subject"),
            F.explode(F.array_distinct(F.array_append(listed, F.col("country_code")))).alias(
                "country_code"
            ),
        )
        .distinct()
    )
    return pairs.join(index, "country_code").select(
        "subject",
        "country_code",
        (F.col("subject") == F.col("country_code")).alias("is_self"),
        "feature_class",
        "total",
        "population",
        "index_by_class",
    )
