"""Writers. A rebalance before each write sizes files and splits a hot country over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_places(places: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by country, so a country filter reads only its folder."""
    balanced = places.hint("rebalance", "country_code")
    balanced.write.mode(mode).partitionBy("country_code").parquet(path)


def write_places_csv(places: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless gzip CSV with columns in schema order, for readers of the old layout."""
    places.hint("rebalance").write.mode(mode).option("compression", "gzip").csv(path)


def write_archive_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gzip text, one folder per archive, lines exactly as they were in the archive."""
    balanced = lines.select("archive", "line").hint("rebalance", "archive")
    balanced.write.mode(mode).partitionBy("archive").option("compression", "gzip").text(path)


def write_quarantine(bad: DataFrame, path: str, mode: str = "append") -> None:
    """Lines that don't fit a schema, as Parquet with the file each comes from, to be looked at and read again."""
    bad.select("file", "bad_line").hint("rebalance").write.mode(mode).parquet(path)
