"""The analyses a user asks for, composed from the operators.

Each takes tables and the choices a user makes, and returns the table behind the chart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from placelens.operators import facility, profile
from placelens.operators.density import density_grid
from placelens.operators.radius import count_within
from placelens.operators.selection import (
    country_geoname,
    feature_points,
    keyword_features,
    keyword_group,
    places_in_country,
    places_with_codes,
    suffix_features,
)

Patterns = Mapping[str, Sequence[str]]


def _patterns(group: str | Patterns) -> Patterns:
    return keyword_group(group) if isinstance(group, str) else group


def facilities_of(
    places: DataFrame, codes: DataFrame, info: DataFrame, group: str | Patterns = "health"
) -> DataFrame:
    """Facilities of a keyword group per country and code."""
    return facility.facility_counts(places, keyword_features(codes, _patterns(group)), info)


def world_index(
    places: DataFrame, codes: DataFrame, info: DataFrame, group: str | Patterns = "health"
) -> DataFrame:
    """Population per facility of every country, plain and scaled to 0..1."""
    totals = facility.country_totals(facilities_of(places, codes, info, group))
    return facility.country_index_scaled(facility.country_index(totals))


def code_index_of_country(
    places: DataFrame,
    codes: DataFrame,
    info: DataFrame,
    group: str | Patterns = "health",
    country_code: str | None = None,
) -> DataFrame:
    """Population per facility by code, described; for one country or all."""
    index = facility.code_index(facilities_of(places, codes, info, group))
    if country_code is not None:
        index = places_in_country(index, country_code)
    return facility.code_index_described(index, codes)


def proximity(
    places: DataFrame,
    codes: DataFrame,
    base: str | Patterns = "school",
    analysed: str | Patterns = "health",
    country_code: str | None = None,
    radius: float = 2.0,
    metric: str = "polygon_deg",
    match_country: bool = True,
    splits: tuple[int, ...] = (4, 4),
) -> DataFrame:
    """Every base place with the number of analysed places near it; for one country or all."""
    if country_code is not None:
        places = places_in_country(places, country_code)
    return count_within(
        feature_points(places, keyword_features(codes, _patterns(base))),
        feature_points(places, keyword_features(codes, _patterns(analysed))),
        radius,
        metric,
        match_country,
        splits,
    )


def base_density(
    places: DataFrame,
    codes: DataFrame,
    mapping: DataFrame,
    info: DataFrame,
    shapes: DataFrame,
    base: str | Patterns = "school",
    size: int = 100,
) -> DataFrame:
    """Density of base places over each country, clipped to its outline.

    ``shapes`` is keyed by geonameid; the country code comes by way of the names.
    """
    outlines = shapes.join(country_geoname(mapping, info), "geonameid").select(
        "country_code", "polygons"
    )
    points = feature_points(places, keyword_features(codes, _patterns(base)))
    return density_grid(points, outlines, size)


def class_profile(places: DataFrame, names: DataFrame, mapping: DataFrame, rules: DataFrame) -> DataFrame:
    """Largest and smallest class of every country with the advice for it."""
    distribution = profile.class_distribution(places, names, mapping)
    return profile.class_advice(profile.extreme_classes(distribution), rules)


def warehouse_places(places: DataFrame, codes: DataFrame) -> DataFrame:
    """Places whose class and code have a description ending in a health word."""
    return places_with_codes(places, suffix_features(codes))
