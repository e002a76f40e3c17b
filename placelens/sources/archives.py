"""Zip archives of place dumps: keep the member named like the archive."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_PER_BATCH = 20_000


def _stem(path: str) -> str:
    return posixpath.basename(path).split(".")[0]


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            stem = _stem(path)
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.namelist():
                    if member.split(".")[0] == stem:
                        yield from _line_batches(archive, member, stem)


def _line_batches(archive: zipfile.ZipFile, member: str, stem: str) -> Iterator[pd.DataFrame]:
    """Stream one member: only a batch of lines is held unpacked."""
    with io.TextIOWrapper(archive.open(member), encoding="utf-8", errors="replace", newline="\n") as text:
        lines: list[str] = []
        for line in text:
            lines.append(line.rstrip("\r\n"))
            if len(lines) == LINES_PER_BATCH:
                yield pd.DataFrame({"archive": stem, "line": lines})
                lines = []
        if lines:
            yield pd.DataFrame({"archive": stem, "line": lines})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, line) of the matching member of every zip under ``path``.

    A zip cannot be split, so each is unpacked by one task; archives spread over tasks. An archive is read as
    one value, so it must be under 2 GiB packed; unpacked lines stream. Bytes that are not UTF-8 become U+FFFD.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .load(path)
        .select("path", "content")
    )
    return files.mapInPandas(_expand, "archive STRING, line STRING")


def parse_place_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Columns of tab-separated ``line`` values, with the same types as the file reader.

    As there, blank lines are skipped, and columns that a short line lacks are null.
    """
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    parts = F.split("line", "\t")
    columns = [
        F.expr("try_cast(nullif(get(_p, %d), '') AS %s)" % (i, kind)).alias(name)
        for i, (name, kind) in enumerate(fields)
    ]
    return lines.filter("line <> ''").withColumn("_p", parts).select("archive", *columns)
