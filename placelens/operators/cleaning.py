"""Raw dump to clean place table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.schemas import UNUSED_COLUMNS

ZERO_FILLED = ["latitude", "longitude", "population"]
BLANK_FILLED = ["name", "feature_class", "feature_code", "country_code", "timezone"]


def clean_places(raw: DataFrame, drop_unlocated: bool = False) -> DataFrame:
    """Drop unused columns, turn NaN into null, then fill numbers with 0 and text with "".

    A missing elevation stays null. Places without coordinates end up at (0, 0) unless
    ``drop_unlocated`` removes them first.
    """
    kept = raw.drop(*UNUSED_COLUMNS)
    nan_free = kept.withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c, kind in kept.dtypes if kind in ("double", "float")}
    )
    if drop_unlocated:
        nan_free = nan_free.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    return nan_free.na.fill(0, ZERO_FILLED).na.fill("", BLANK_FILLED)
