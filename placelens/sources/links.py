"""Download links found in crawled index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.functions.text import after_last_slashes, before_first_dot

ANCHOR = r'<[aA]\s(?:[^>]*?\s)?[hH][rR][eE][fF]\s*=\s*("[^"]*"|\'[^\']*\'|[^\s>"\']+)'
COMMENT = r"(?s)<!--.*?-->"
# The escapes HTML needs inside an attribute.
ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def page_links(
    pages: DataFrame, base_url: str, suffix: str = "", stem_length: int = 2
) -> DataFrame:
    """Anchors of each page whose target ends with ``suffix`` and has a short enough stem.

    The stem is the target up to its first dot and must have exactly ``stem_length``
    characters. Anchors without a target are skipped. One row per anchor.
    """
    anchors = pages.select(
        "page_id",
        F.explode(
            F.regexp_extract_all(F.regexp_replace("html", COMMENT, ""), F.lit(ANCHOR), F.lit(1))
        ).alias("link"),
    )
    target = F.regexp_replace("link", "^[\"']|[\"']$", "")
    for escape, char in ENTITIES:
        target = F.replace(target, F.lit(escape), F.lit(char))
    kept = anchors.withColumn("link", target).filter(
        F.col("link").endswith(suffix) & (F.length(before_first_dot(F.col("link"))) == stem_length)
    )
    url = F.concat(F.lit(base_url), F.lit("/"), F.col("link"))
    return kept.withColumn("url", url).withColumn("file_name", after_last_slashes(F.col("url")))
