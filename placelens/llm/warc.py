"""WARC derivatives: metadata and plain-text conversion records for response records.

A response record is a row: record_id, target_uri, date, http (its HTTP head) and payload. For each, two
records are derived, both with WARC-Refers-To on its record id, and with its URI and date. The conversion
record holds the plain text of the HTML payload; the metadata record holds warc-fields: the source's HTTP
headers, its payload digest, and the digest and id of the conversion. Records are rendered to the bytes of a WARC file and
:func:`parse_record` reads them back. Ids come from digests, so a task that runs again writes the same.

Digests are ``sha1:`` in base 32, as the WARC standard's examples have them. HTML becomes text by
patterns: scripts, styles, comments and heads without their contents, line ends at block elements, other
tags dropped, character references decoded, white space folded.

Edge cases: a null payload is empty, and so is its text; null ids or URIs are empty header values;
control characters in a URI or header are encoded for urls, so they can't break a record; repeated rows
give repeated records with equal ids; other columns don't matter; an empty table gives no rows; every record is handled by itself, a very
long or broken page in time in proportion to its length.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm.shared import column

DATE = "1970-01-01T00:00:00Z"
_HIDDEN = re.compile(r"<(?:!--|(script|style|template|noscript)\b)", re.I)
_CLOSED = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "template", "noscript")} | {"": re.compile("-->")}
_BLOCK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|thead|tbody|section|article|nav|header|footer|main|aside|form|title"
    r"|blockquote|pre|figure)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<![^>]*>|<\?[^>]*>")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def without_hidden(page: str) -> str:
    """The page with a space for each comment, script, style, template and noscript that is closed; one pass."""
    pieces, kept, at, unclosed = [], 0, 0, set()
    while found := _HIDDEN.search(page, at):
        kind = (found[1] or "").lower()
        at = found.end()
        if kind in unclosed:
            continue
        close = _CLOSED[kind].search(page, at)
        if close is None:
            unclosed.add(kind)
            continue
        pieces += page[kept : found.start()], " "
        kept = at = close.end()
    return "".join([*pieces, page[kept:]])


def plain_text(page: str) -> str:
    text = without_hidden(page).replace("\r", " ").replace("\n", " ")
    # No tag ends in what is behind the last ``>``, and a search there would go over it from every ``<``.
    end = text.rfind(">") + 1
    text = _TAG.sub("", _BLOCK.sub("\n", text[:end])) + text[end:]
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def _value(text: str) -> str:
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", text)


def render_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {_value(v)}" for k, v in headers.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises ValueError where it isn't one."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.partition(": ")[::2] for x in lines[1:])
    length = int(headers.get("Content-Length", -1))
    if not found or not lines[0].startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:length]


def derive(source_id: str, uri: str, date: str, http: str, payload: str) -> list[tuple[dict[str, str], bytes]]:
    """The conversion and the metadata record of a response, as headers and block."""
    payload_digest = digest(payload.encode())
    text = plain_text(payload).encode()
    common = {"WARC-Target-URI": uri, "WARC-Date": date, "WARC-Refers-To": source_id}
    conversion = {
        "WARC-Type": "conversion",
        "WARC-Record-ID": record_id("conversion", source_id, payload_digest),
        **common,
        "Content-Type": "text/plain",
        "WARC-Block-Digest": digest(text),
    }
    fields = [f"source-{k.lower()}: {_value(v)}" for k, v in http_headers(http)]
    fields += [
        f"source-payload-digest: {payload_digest}",
        f"source-payload-length: {len(payload.encode())}",
        f"conversion-record-id: {conversion['WARC-Record-ID']}",
        f"conversion-block-digest: {conversion['WARC-Block-Digest']}",
    ]
    block = "".join(f + "\r\n" for f in fields).encode()
    metadata = {
        "WARC-Type": "metadata",
        "WARC-Record-ID": record_id("metadata", source_id, payload_digest),
        **common,
        "Content-Type": "application/warc-fields",
        "WARC-Block-Digest": digest(block),
    }
    return [(conversion, text), (metadata, block)]


def http_headers(http: str) -> list[tuple[str, str]]:
    """Names and values of an HTTP head, in order; the status line is the header ``status``."""
    lines = [x for x in http.split("\r\n") if x]
    return [("status", x) if i == 0 and x.startswith("HTTP/") else x.partition(": ")[::2] for i, x in enumerate(lines)]


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response rows of crawled pages; the record id is made of page id, url and content."""
    key = F.sha2(
        F.concat_ws("\u0000", F.coalesce(column(id_col).cast("string"), F.lit("")), F.coalesce(column(url_col), F.lit("")),
                    F.coalesce(column(html_col), F.lit(""))), 256,
    )
    uid = F.regexp_replace(F.substring(key, 1, 32), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")
    return pages.select(
        column(id_col).alias("source"),
        F.concat(F.lit("<urn:uuid:"), uid, F.lit(">")).alias("record_id"),
        column(url_col).alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n").alias("http"),
        column(html_col).alias("payload"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows for each response: source, warc_type, record_id, refers_to and the whole ``record``."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                columns = [part.column(c).to_pylist() for c in ("record_id", "target_uri", "date", "http", "payload")]
                made = [derive(*[x or "" for x in row]) for row in zip(*columns, strict=True)]
                flat = [pair for pairs in made for pair in pairs]
                index = pa.array([i for i, pairs in enumerate(made) for _ in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("source").take(index),
                        *[pa.array([h[n] for h, _ in flat]) for n in ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To")],
                        pa.array([render_record(h, b) for h, b in flat], pa.binary()),
                    ],
                    ["source", "warc_type", "record_id", "refers_to", "record"],
                )

    kind = responses.schema["source"].dataType.simpleString()
    columns = responses.select("source", "record_id", "target_uri", "date", "http", "payload")
    return columns.mapInArrow(run, f"source {kind}, warc_type string, record_id string, refers_to string, record binary")


def read_back(records: DataFrame) -> DataFrame:
    """source, headers (map) and block of rendered records."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                read = [parse_record(r) for r in part.column("record").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("source"),
                        pa.array([list(h.items()) for h, _ in read], pa.map_(pa.string(), pa.string())),
                        pa.array([b for _, b in read], pa.binary()),
                    ],
                    ["source", "headers", "block"],
                )

    kind = records.schema["source"].dataType.simpleString()
    return records.select("source", "record").mapInArrow(run, f"source {kind}, headers map<string,string>, block binary")
