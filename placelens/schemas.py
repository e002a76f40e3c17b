"""Table schemas, as DDL strings for ``spark.read.schema``.

Coordinates are DOUBLE (a 32-bit float moves a point by up to a metre) and place
ids BIGINT. CSV sources have no header, so columns are matched by position.
"""

# Column names and order of the place dump and its companion tables.
RAW_PLACES = (
    "geonameid BIGINT, name STRING, ascii_name STRING, alternate_names STRING, "
    "latitude DOUBLE, longitude DOUBLE, feature_class STRING, feature_code STRING, "
    "country_code STRING, cc2 STRING, admin1_code STRING, admin2_code STRING, "
    "admin3_code STRING, admin4_code STRING, population BIGINT, elevation INT, "
    "dem STRING, timezone STRING, modification_date DATE"
)
UNUSED_COLUMNS = [
    "ascii_name", "alternate_names", "cc2", "admin1_code",
    "admin2_code", "admin3_code", "admin4_code", "dem",
]
CLEAN_PLACES = (
    "geonameid BIGINT, name STRING, latitude DOUBLE, longitude DOUBLE, "
    "feature_class STRING, feature_code STRING, country_code STRING, "
    "population BIGINT, elevation INT, timezone STRING, modification_date DATE"
)
ENRICHED_PLACES = CLEAN_PLACES + ", country STRING"
FEATURE_CODES = (
    "feature_class STRING, feature_code STRING, "
    "short_description STRING, long_description STRING"
)
COUNTRY_INFO = (
    "country STRING, capital STRING, area_sq_km BIGINT, population BIGINT, "
    "continent STRING, geonameid BIGINT, neighbours STRING"
)
COUNTRY_MAPPING = "country_code STRING, country STRING"
CLASS_DISTRIBUTION = (
    "country_code STRING, feature_class STRING, feature_description STRING, "
    "no_of_features INT, country STRING"
)
CLASS_NAMES = "feature_class STRING, feature_class_description STRING"

# The nine feature classes and their descriptions.
CLASS_NAME_ROWS = [
    ("A", "country,state,region"),
    ("H", "stream, lake"),
    ("L", "park, area"),
    ("P", "city, village"),
    ("R", "road, railroad"),
    ("S", "spot, building, farm"),
    ("T", "mountain,hill,rock"),
    ("U", "undersea"),
    ("V", "forest,heath"),
]

# A GeoJSON geometry is a MultiPolygon once read: polygons > rings > positions > [lon, lat].
POLYGONS = "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"
