"""What the corpus operators share: folders all executors see, and words of whole Arrow batches as numpy arrays.

Words are runs of bytes other than the six ASCII white-space characters; A-Z are lower-cased.
A word is a 64-bit hash: two words of a corpus are confused with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
_SPACES = (0x20, *range(0x09, 0x0E))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True


# Folders.


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where none is set, a temporary folder, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return root.rstrip("/")


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="placelens-")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/placelens-{uuid.uuid4().hex[:12]}/{name}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage and survives lost executors. options: of its writer."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    for scope in _SCOPES.get():
        scope.tables.append(table)
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` gave; nothing that reads them may run afterwards."""
    for table in tables:
        path = table.__dict__.pop("scratch", None)
        if path:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scope:
    """``with Scope() as scope``: at the end, tables that were materialised inside go, but for those given to ``keep``."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def keep(self, table: DataFrame) -> DataFrame:
        self.tables = [t for t in self.tables if t is not table]
        return table

    def __enter__(self) -> Scope:
        self.token = _SCOPES.set((*_SCOPES.get(), self))
        return self

    def __exit__(self, *error: object) -> None:
        _SCOPES.reset(self.token)
        release(*self.tables)


def materialize_alone(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that ``build`` gives, without those that were made on the way."""
    with Scope() as scope:
        return scope.keep(materialize(build(), name))


_SCOPES: ContextVar[tuple[Scope, ...]] = ContextVar("scopes", default=())


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def crc_of_id(id_col: str) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column(id_col).cast("string"), F.lit("")).cast("binary"))


# Hashes.


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(n: int, seed: int) -> np.ndarray:
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * step) | np.uint64(1)


_BYTE = _keys(256, 1)
_PLACE = _keys(1 << 12, 2)
_SLOT = _keys(64, 3)
_PAD = np.uint64(0x5851F42D4C957F2D)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = _keys(1 << int(n - 1).bit_length(), 2)
    return _PLACE


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several aligned arrays of hashes, by place."""
    total = np.zeros(len(parts[0]), np.uint64)
    for k, p in enumerate(parts):
        total += mix(p + _SLOT[k]) * _SLOT[k + 16]
    return mix(total)


# Words of a batch.


class Words:
    """Words of several texts: byte spans, hashes, text index and place in the text."""

    def __init__(self, texts: pa.Array, lower: bool = True, dropped: np.ndarray | None = None):
        """dropped: which bytes are left out of the hashes, by byte; words without others vanish.

        With it, capitals of Latin-1 are lower-cased as well.
        """
        self.data, self.offsets = text_bytes(texts)
        data, n = self.data, len(self.data)
        self.texts = len(self.offsets) - 1
        kept = ~_IS_SPACE[data]
        first = np.zeros(n + 1, bool)
        first[self.offsets[:-1]] = True
        if dropped is not None:
            space = ~kept
            kept &= ~dropped[data]
            block = np.cumsum(space | first[:n])  # changes between words
        at = np.flatnonzero(kept)
        if dropped is None:
            new = first[at] | np.r_[True, np.diff(at) > 1] if len(at) else np.zeros(0, bool)
        else:
            b = block[at]
            new = np.r_[True, b[1:] != b[:-1]] if len(at) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        self.count = len(starts)
        lengths = np.diff(np.r_[starts, len(at)])
        self.start = at[starts]
        self.end = at[starts + lengths - 1] + 1 if self.count else self.start
        if self.count:
            letters = data[at]
            letters = _LOWER[letters] if lower else letters
            if dropped is not None and len(letters) > 1:
                # Capitals of two bytes from U+00C0 to U+00DE.
                capital = (letters[:-1] == 0xC3) & (letters[1:] >= 0x80) & (letters[1:] <= 0x9E) & (letters[1:] != 0x97)
                letters[1:][capital] += 32
            place = np.arange(len(at)) - np.repeat(starts, lengths)
            values = _BYTE[letters] * _places(int(lengths.max()))[place]
            self.hash = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)
        self.text = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.per_text = np.bincount(self.text, minlength=self.texts)
        self.first = np.r_[0, np.cumsum(self.per_text)]
        self.place = np.arange(self.count) - self.first[self.text]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every run of k words; a text with fewer words is one run."""
        last = np.maximum(self.per_text - k, 0)
        at = np.flatnonzero(self.place <= last[self.text])
        text = self.text[at]
        padded = np.r_[self.hash, np.full(k, _PAD)]
        end = self.first[text + 1]
        return text, combine([np.where(at + j < end, padded[at + j], _PAD) for j in range(k)])

    def ngrams(self, n: int, edge: np.uint64) -> np.ndarray:
        """For every word the hash of it and the n - 1 words before, ``edge`` before the text."""
        parts = []
        for j in range(n - 1, -1, -1):
            before = self.place >= j
            at = np.arange(self.count) - j
            parts.append(np.where(before, self.hash[np.maximum(at, 0)] if self.count else self.hash, edge))
        return combine(parts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each starts; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text; a longer text comes alone, whole."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size.astype(np.int64)), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def map_chunks(
    df: DataFrame, text: str, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``function`` over chunks of a narrow table; it may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            out = function(chunk)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list array with ``counts`` values for each row."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values))


# Bloom filters in segments.

SEGMENT_BITS = 1 << 20
PROBES = 6
PLACE_SHIFT = np.uint64(44)


def segments_for(entries: int, bits_per_entry: int = 12) -> int:
    return max(1, -(-entries * bits_per_entry // SEGMENT_BITS))


def bloom_places(keys: np.ndarray, salt: np.ndarray | int = 0, probes: range = range(PROBES)) -> np.ndarray:
    """Bit numbers inside a key's segment, a row for each probe."""
    a, b = bloom_steps(keys, salt)
    steps = np.array(probes, np.uint64)[:, None] + np.uint64(1)
    return ((a + steps * b) >> PLACE_SHIFT) & np.uint64(SEGMENT_BITS - 1)


def bloom_steps(keys: np.ndarray, salt: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """a and b of each key: probe i looks at bit (a + (i + 1) * b) >> PLACE_SHIFT."""
    a = mix(keys + np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return a, mix(a ^ _PAD) | np.uint64(1)


def bloom_segment(keys: np.ndarray, count: int) -> np.ndarray:
    return ((mix(keys ^ np.uint64(0x1234567)) >> np.uint64(32)) % np.uint64(count)).astype(np.int64)


def bloom_probe(
    bits: np.ndarray, keys: np.ndarray, salt: np.ndarray | int = 0, first: int = 0, segments: int | None = None
) -> np.ndarray:
    """Which keys the filter may hold. bits: a row of bytes for each segment, from ``first`` on, of ``segments`` (default all).

    The keys' segments must be among those of ``bits``.
    """
    segments = len(bits) if segments is None else segments
    found = np.zeros(len(keys), bool)
    alive = np.arange(len(keys))
    # Most keys that aren't there fail the first probe.
    for probes in (range(1), range(1, PROBES)):
        own = keys[alive]
        segment, kept = bloom_segment(own, segments) - first, np.ones(len(own), bool)
        for place in bloom_places(own, salt, probes):
            byte = bits[segment, (place >> np.uint64(3)).astype(np.int64)]
            kept &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        alive = alive[kept]
    found[alive] = True
    return found


def bloom_table(entries: DataFrame, segments: int) -> DataFrame:
    """(segment int, bits binary) of a filter over ``entries`` (key long, salt int); tasks fill whole segments."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            part = pa.array(bloom_segment(keys, segments).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part, batch.column("key"), batch.column("salt")], ["segment", "key", "salt"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            part = batch.column("segment").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            salt = batch.column("salt").to_numpy(zero_copy_only=False).astype(np.uint64)
            places = bloom_places(keys, salt)
            for s in np.unique(part):
                own = bits.setdefault(int(s), np.zeros(SEGMENT_BITS // 8, np.uint8))
                flat = np.zeros(SEGMENT_BITS, bool)
                flat[places[:, part == s].ravel().astype(np.int64)] = True
                own |= np.packbits(flat, bitorder="little")
        if bits:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(bits), pa.int32()), pa.array([b.tobytes() for b in bits.values()], pa.binary())],
                ["segment", "bits"],
            )

    routed = entries.select("key", "salt").mapInArrow(route, "segment int, key long, salt int")
    return routed.repartition("segment").mapInArrow(fill, "segment int, bits binary")


def bloom_bits(table: DataFrame, first: int, last: int) -> np.ndarray:
    """Bits of the segments from ``first`` to before ``last`` of a filter's table, a row of bytes for each."""
    out = np.zeros((last - first, SEGMENT_BITS // 8), np.uint8)
    for row in table.where((F.col("segment") >= first) & (F.col("segment") < last)).toLocalIterator():
        out[row.segment - first] |= np.frombuffer(row.bits, np.uint8)
    return out


def build_bloom(entries: DataFrame, segments: int) -> np.ndarray:
    """Bits of a filter over ``entries`` (key long, salt int), a row of bytes for each segment.

    The driver receives ``segments`` x 128 KiB, whatever the number of entries. The caller bounds ``segments``.
    """
    return bloom_bits(bloom_table(entries, segments), 0, segments)
