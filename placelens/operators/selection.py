"""Selecting places, codes and countries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.functions.text import column_matches, ends_with_any, matches_any
from placelens.plans.joins import join_dimension

# Keyword groups and warehouse suffixes.
KEYWORD_GROUPS = {
    "health": {
        "short_description": ["hospital", "medical"],
        "long_description": ["hospital", "medical"],
    },
    "school": {"short_description": ["school", "university"]},
}
SUFFIX_COLUMNS = ["short_description", "long_description"]
SUFFIX_WORDS = ["hospital", "medical", "pharmacy"]

CODE_KEY = ["feature_code"]
CLASS_AND_CODE_KEY = ["feature_class", "feature_code"]


def keyword_group(name: str, groups: Mapping = KEYWORD_GROUPS) -> Mapping[str, Sequence[str]]:
    if name not in groups:
        raise ValueError(f"unknown keyword group {name!r}; known: {', '.join(sorted(groups))}")
    return groups[name]


def keyword_features(codes: DataFrame, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct dictionary rows that match any pattern in any of the given columns."""
    return codes.filter(matches_any(patterns)).dropDuplicates()


def keyword_features_union(codes: DataFrame, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Same result as :func:`keyword_features`, as one filter per column and a union."""
    found = codes.limit(0)
    for column, words in patterns.items():
        found = found.union(codes.filter(column_matches(column, words)))
    return found.dropDuplicates()


def suffix_features(
    codes: DataFrame, columns: Sequence[str] = SUFFIX_COLUMNS, words: Sequence[str] = SUFFIX_WORDS
) -> DataFrame:
    """Dictionary rows in which a description ends with one of the words; duplicates stay."""
    return codes.filter(ends_with_any(columns, words))


def places_in_country(places: DataFrame, country_code: str) -> DataFrame:
    return places.filter(F.col("country_code") == country_code)


def places_by_class(enriched: DataFrame, country: str, feature_class: str) -> DataFrame:
    return enriched.filter((F.col("country") == country) & (F.col("feature_class") == feature_class))


def enrich_places(places: DataFrame, mapping: DataFrame) -> DataFrame:
    """Places with the country name; places of an unmapped country keep a null name."""
    return join_dimension(places, mapping.select("country_code", "country"), ["country_code"], "left")


def places_with_codes(places: DataFrame, codes: DataFrame) -> DataFrame:
    """Places joined with dictionary rows on class and code."""
    return join_dimension(places, codes, CLASS_AND_CODE_KEY)


def feature_points(places: DataFrame, matched: DataFrame) -> DataFrame:
    """Places whose code is among the matched dictionary rows.

    Joined on code alone: a code listed under several classes gives one row for each,
    told apart by ``matched_feature_class``.
    """
    codes = matched.select(
        "feature_code",
        F.col("feature_class").alias("matched_feature_class"),
        "short_description",
        "long_description",
    )
    return join_dimension(places, codes, CODE_KEY)


def with_point(points: DataFrame) -> DataFrame:
    """Adds ``point``, a struct of longitude and latitude."""
    return points.withColumn(
        "point", F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    )


def country_codes(places: DataFrame, info: DataFrame) -> DataFrame:
    """Country attributes with the code carried by the country's own row among the places."""
    return join_dimension(places.select("geonameid", "country_code"), info, ["geonameid"])


def country_geoname(mapping: DataFrame, info: DataFrame) -> DataFrame:
    """Code, name and place id of every country, matched by name."""
    return mapping.select("country_code", "country").join(
        info.select("country", "geonameid"), "country"
    )


def first_places(places: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in a stated order: a top-n, not a full sort."""
    return places.orderBy(*order).limit(n)
