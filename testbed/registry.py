"""Query name -> callable(spark, sf_dir) over whole driver tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.functions.geometry import ring
from placelens.operators import facility, profile, selection
from placelens.operators.cleaning import clean_places
from placelens.operators.containment import points_in_shapes
from placelens.operators.density import density_grid
from placelens.operators.radius import count_within
from placelens.plans import analyses
from placelens.sources import clustered
from placelens.sources.links import page_links
from placelens.sources.shapes import keyed_shapes, read_shapes
from placelens.streaming import refresh
from testbed import adapters as t

DIGITS = 6
BASE_URL = "http://example.org/dump/"
COUNTRY_CODE = "19"
COUNTRY, CLASS = "NATION_19", "P"
BOX = (-61.0, -36.0, -55.2502, -30.2502)
DENSITY_CELLS = 100

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    """Register under the function name; a trailing underscore only avoids a clash."""
    _QUERIES[f.__name__.rstrip("_")] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """A result in a form two engines print alike.

    Doubles rounded, dates as text, and the one integer column with nulls as a double.
    """

    def shown(name: str, kind: str):
        if kind == "double":
            return F.round(name, digits).alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        if name == "elevation":
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[shown(*column) for column in df.dtypes])


# Shared intermediate results.


def _health(spark, sf):
    return selection.keyword_features(t.feature_codes(spark, sf), t.HEALTH)


def _school(spark, sf):
    return selection.keyword_features(t.feature_codes(spark, sf), t.SCHOOL)


def _facilities(spark, sf):
    return analyses.facilities_of(
        t.places(spark, sf), t.feature_codes(spark, sf), t.country_info(spark, sf), t.HEALTH
    )


def _index(spark, sf):
    return facility.country_index(facility.country_totals(_facilities(spark, sf)))


def _enriched(spark, sf):
    return selection.enrich_places(t.places(spark, sf), t.country_mapping(spark, sf))


def _distribution(spark, sf):
    return profile.class_distribution(
        t.places(spark, sf), t.class_names(spark, sf), t.country_mapping(spark, sf)
    )


# Scans, cleaning, links.


@_query
def places_scan(spark, sf):
    return _rounded(t.places(spark, sf))


@_query
def page_links_(spark, sf):
    return page_links(t.table(spark, sf, "pages"), BASE_URL, suffix="", stem_length=3)



@_query
def clean_places_(spark, sf):
    return _rounded(clean_places(t.raw_places(spark, sf)))



@_query
def clean_places_located(spark, sf):
    return _rounded(clean_places(t.raw_places(spark, sf), drop_unlocated=True))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that executors share; without the cluster's setting a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="placelens-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _store(spark, sf) -> str:
    """A store refreshed from raw dump files, which are the raw places written as tab-separated text."""
    dump, store = _folder(spark, "dump"), _folder(spark, "store")
    text = t.raw_places(spark, sf).write.option("sep", "\t").option("quote", "")
    text.option("emptyValue", "").option("nullValue", "").csv(dump)
    refresh.refresh_changed(spark, dump, store)
    return store


@_query
def refreshed_places(spark, sf):
    return _rounded(refresh.read_places(spark, _store(spark, sf)))


@_query
def refreshed_counts(spark, sf):
    return refresh.read_counts(spark, _store(spark, sf))


@_query
def geojson_shapes(spark, sf):
    """Every corner of the shapes, after they were written as GeoJSON features and read back."""
    shapes, folder = t.country_shapes(spark, sf), _folder(spark, "geojson")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("geoNameId").alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.col("polygons").alias("coordinates")).alias("geometry"),
    )
    shapes.select(F.to_json(feature).alias("value")).write.text(folder)
    back = keyed_shapes(read_shapes(spark, folder, lines=True))
    rings = back.select("geonameid", F.posexplode(F.flatten("polygons")).alias("ring", "positions"))
    corners = rings.select("geonameid", "ring", F.posexplode("positions").alias("vertex", "position"))
    return _rounded(
        corners.select(
            "geonameid",
            F.col("ring").cast("bigint").alias("ring"),
            F.col("vertex").cast("bigint").alias("vertex"),
            F.get("position", F.lit(0)).alias("lon"),
            F.get("position", F.lit(1)).alias("lat"),
        )
    )


@_query
def clustered_places_in_box(spark, sf):
    """Places of one region, after all were written along a space-filling curve."""
    folder = _folder(spark, "clustered")
    clustered.write_clustered(t.places(spark, sf), folder)
    return _rounded(clustered.in_box(clustered.read_clustered(spark, folder), *BOX))


# Filters and lookups.


@_query
def places_in_country(spark, sf):
    return _rounded(selection.places_in_country(t.places(spark, sf), COUNTRY_CODE))


@_query
def places_by_class(spark, sf):
    return _rounded(selection.places_by_class(_enriched(spark, sf), COUNTRY, CLASS))


@_query
def keyword_features(spark, sf):
    return _health(spark, sf)


@_query
def keyword_features_short_only(spark, sf):
    return _school(spark, sf)


@_query
def keyword_features_union(spark, sf):
    return selection.keyword_features_union(t.feature_codes(spark, sf), t.HEALTH)


@_query
def suffix_features(spark, sf):
    return selection.suffix_features(t.feature_codes(spark, sf), *t.SUFFIXES)


@_query
def places_first_n(spark, sf):
    order = ["geonameid", "name", "feature_code", "latitude", "longitude", "modification_date", "population"]
    return _rounded(selection.first_places(t.places(spark, sf), order, 1080))


@_query
def places_enriched(spark, sf):
    return _rounded(_enriched(spark, sf))


@_query
def country_codes(spark, sf):
    return selection.country_codes(t.places(spark, sf), t.country_info(spark, sf))


@_query
def country_geoname(spark, sf):
    return selection.country_geoname(t.country_mapping(spark, sf), t.country_info(spark, sf))


# Facilities and indexes.


@_query
def code_counts(spark, sf):
    return facility.code_counts(t.places(spark, sf))


@_query
def facility_counts(spark, sf):
    return _facilities(spark, sf)


@_query
def facility_counts_by_class(spark, sf):
    return facility.facility_counts(
        t.places(spark, sf),
        _health(spark, sf),
        t.country_info(spark, sf),
        selection.CLASS_AND_CODE_KEY,
    )


@_query
def country_totals(spark, sf):
    return facility.country_totals(_facilities(spark, sf))


@_query
def country_index(spark, sf):
    return _rounded(_index(spark, sf))


@_query
def country_index_scaled(spark, sf):
    return _rounded(
        analyses.world_index(
            t.places(spark, sf), t.feature_codes(spark, sf), t.country_info(spark, sf), t.HEALTH
        )
    )


@_query
def country_index_log(spark, sf):
    return _rounded(facility.country_index_log(facility.country_index_scaled(_index(spark, sf))))


@_query
def code_index(spark, sf):
    return _rounded(facility.code_index(_facilities(spark, sf)))


@_query
def code_index_described(spark, sf):
    return _rounded(
        analyses.code_index_of_country(
            t.places(spark, sf), t.feature_codes(spark, sf), t.country_info(spark, sf), t.HEALTH
        )
    )


@_query
def neighbour_compare(spark, sf):
    return _rounded(facility.neighbour_compare(_index(spark, sf)))


@_query
def shapes_with_index(spark, sf):
    scaled = facility.country_index_scaled(_index(spark, sf))
    joined = facility.shapes_with_index(keyed_shapes(t.country_shapes(spark, sf)), scaled)
    rings = joined.select("*", F.posexplode(F.flatten("polygons")).alias("ring", "positions"))
    corners = rings.select("*", F.posexplode("positions").alias("vertex", "position"))
    return _rounded(
        corners.select(
            "geonameid",
            "country_code",
            "feature_class",
            F.col("ring").cast("bigint").alias("ring"),
            F.col("vertex").cast("bigint").alias("vertex"),
            F.get("position", F.lit(0)).alias("lon"),
            F.get("position", F.lit(1)).alias("lat"),
            "scaled_index",
        )
    )


# Class profile.


@_query
def class_distribution(spark, sf):
    return _distribution(spark, sf)


@_query
def class_share(spark, sf):
    return _rounded(profile.class_share(_distribution(spark, sf)))


@_query
def class_descriptions(spark, sf):
    return profile.class_descriptions(_distribution(spark, sf))


@_query
def class_lookup(spark, sf):
    return profile.class_lookup(
        profile.class_descriptions(_distribution(spark, sf)), t.class_names(spark, sf)
    )


@_query
def extreme_classes(spark, sf):
    return profile.extreme_classes(_distribution(spark, sf))


@_query
def class_advice(spark, sf):
    return analyses.class_profile(
        t.places(spark, sf),
        t.class_names(spark, sf),
        t.country_mapping(spark, sf),
        profile.advice_rules(spark),
    )


@_query
def class_code_counts(spark, sf):
    return profile.class_code_counts(_enriched(spark, sf))


@_query
def class_code_join(spark, sf):
    return selection.places_with_codes(
        profile.class_code_counts(_enriched(spark, sf)), t.feature_codes(spark, sf)
    )


@_query
def code_share(spark, sf):
    return _rounded(
        profile.code_share(
            profile.class_code_counts(_enriched(spark, sf)), t.feature_codes(spark, sf)
        )
    )


@_query
def suffix_places(spark, sf):
    matched = selection.suffix_features(t.feature_codes(spark, sf), *t.SUFFIXES)
    return _rounded(selection.places_with_codes(t.places(spark, sf), matched))


# Points, radius, outlines, density.


@_query
def feature_points(spark, sf):
    points = selection.with_point(selection.feature_points(t.places(spark, sf), _health(spark, sf)))
    return _rounded(
        points.select(
            "geonameid",
            "country_code",
            "feature_class",
            "feature_code",
            "matched_feature_class",
            F.col("point.lon").alias("lon"),
            F.col("point.lat").alias("lat"),
        )
    )


@_query
def buffer_ring(spark, sf):
    points = t.base_points(spark, sf)
    vertices = points.select(
        "id", F.posexplode(ring(F.col("longitude"), F.col("latitude"), 2.0)).alias("vertex", "p")
    )
    return _rounded(vertices.select("id", "vertex", "p.lon", "p.lat"))


def _within(metric: str, radius: float, match_country: bool = True) -> Query:
    def run(spark, sf):
        counted = count_within(
            t.base_points(spark, sf), t.facility_points(spark, sf), radius, metric, match_country
        )
        return counted.select("id", "country_code", "n_within")

    return run


_QUERIES["within_polygon_deg"] = _within("polygon_deg", 2.0)
_QUERIES["within_circle_deg"] = _within("circle_deg", 2.0)
_QUERIES["within_km"] = _within("km", 250.0)
_QUERIES["within_km_any_country"] = _within("km", 2500.0, match_country=False)


@_query
def place_proximity(spark, sf):
    near = analyses.proximity(
        t.places(spark, sf), t.feature_codes(spark, sf), t.SCHOOL, t.HEALTH, radius=2.0
    )
    return near.select("geonameid", "country_code", "feature_code", "matched_feature_class", "n_within")


@_query
def points_in_country_shape(spark, sf):
    inside = points_in_shapes(
        t.base_points(spark, sf), keyed_shapes(t.country_shapes(spark, sf)), ["geonameid"]
    )
    return inside.select("id", "geonameid")


@_query
def places_in_own_shape(spark, sf):
    outlines = keyed_shapes(t.country_shapes(spark, sf)).join(
        selection.country_geoname(t.country_mapping(spark, sf), t.country_info(spark, sf)), "geonameid"
    )
    inside = points_in_shapes(
        t.places(spark, sf), outlines, ["country_code"], match=["country_code"]
    )
    return inside.groupBy("country_code", "feature_code").agg(F.count("*").alias("n_inside"))


@_query
def density_grid_(spark, sf):
    outlines = keyed_shapes(t.country_shapes(spark, sf)).select(
        F.col("geonameid").cast("string").alias("country_code"), "polygons"
    )
    cells = density_grid(t.base_points(spark, sf), outlines, DENSITY_CELLS)
    return cells.select(
        "country_code",
        "ix",
        "iy",
        F.round("longitude", DIGITS).alias("longitude"),
        F.round("latitude", DIGITS).alias("latitude"),
        F.round("density", DIGITS + 2).alias("density"),
    )



@_query
def place_density(spark, sf):
    cells = analyses.base_density(
        t.places(spark, sf),
        t.feature_codes(spark, sf),
        t.country_mapping(spark, sf),
        t.country_info(spark, sf),
        keyed_shapes(t.country_shapes(spark, sf)),
        t.SCHOOL,
        DENSITY_CELLS,
    )
    return cells.select(
        "country_code",
        "ix",
        "iy",
        F.round("longitude", DIGITS).alias("longitude"),
        F.round("latitude", DIGITS).alias("latitude"),
        F.round("density", DIGITS + 2).alias("density"),
    )
