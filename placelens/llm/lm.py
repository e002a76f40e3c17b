"""Language-model scores from a log-frequency Bloom filter.

The model is an interpolated n-gram model over words and one end mark a text. Counts are
quantised: level i stands for counts from the i-th threshold on, thresholds growing by ``base``. An
n-gram of level q is put into a Bloom filter q times, as (n-gram, 1) .. (n-gram, q). To read a count,
(n-gram, 1), (n-gram, 2), .. are probed until one is missing; so a false positive rarely adds
more than one level.

Every n-gram of the training texts is kept, so the filters grow with the corpus. They are tables of segments, of which no
task holds more than ``GROUP``. Texts are cut into words once (:func:`cut`) and packed into chunks, which all steps read.
Counting is over all training texts, by key. A score's n-grams go to their segments: each chunk sends its distinct n-grams
to the groups of segments that hold them, and gets their levels back in the same order. Keys travel sorted and packed, not
as rows; an order at a time, and a step's shuffle files go when it is written. Packed rows are megabytes, so few are copied
between files, Spark and Python at a time (``_stored``). ``filters`` has the bits themselves of models of at most
``MOST_SEGMENTS`` (128 MiB).

P_n(w | h) = (1 - weight) P_{n-1}(w | h') + weight * c(h w) / c(h) where h is in the filter, with the
level's lowest count above and the highest below, else P_{n-1}. P_1 shares what rare words hold evenly among
them and one unseen word. So sums over all words stay at 1 or below but for false positives.

The add-0.1 unigram baseline is exact: counts of words with a share of at least ``exact`` (at most 1 / exact words)
are broadcast, all others are asked of the ranges of words that hold them, as n-grams are.

Edge cases: a null or empty text is the end mark alone; without training texts P_1 is 1 for each
token; a null id counts as the empty text where it is hashed; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.llm import shared as s

MOST_SEGMENTS = 1 << 10
GROUP = 1 << 5  # segments that a task holds at a time
TOGETHER = 1 << 20  # n-grams that a task sorts at a time
BUCKET = 1 << 19  # training tokens for each bucket of keys
PIECE = 1 << 17  # bytes of text that are cut into words at a time, so that their arrays stay in the cache
CHUNK = 1 << 23  # bytes of text whose n-grams are asked for together
RUN = 1 << 15  # tokens that are hashed or scored at a time, about
BATCH = 1 << 22  # bytes that go to Python at a time; a larger row comes alone
ASKED = 1 << 22  # n-grams that a group of segments answers in a task, about
EXACT = 2.0**-19
BASE = 1.4
WEIGHTS = (0.15, 0.4)
_END, _EDGE = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)


def _sequence(words: s.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place of all tokens, the end mark after each text's words."""
    where = words.first[1:]
    hashes = np.insert(words.hash, where, _END)
    per_text = words.per_text + 1
    text = np.repeat(np.arange(words.texts), per_text)
    place = np.arange(len(hashes)) - (np.cumsum(per_text) - per_text)[text]
    return hashes, text, place


def _pieces(texts: pa.Array) -> Iterator[s.Words]:
    for piece in s.chunks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text", PIECE):
        yield s.Words(piece.column("text"))


def _ngrams(hashes: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Key of the n-gram that ends at each token; one mark stands before a text."""
    at = np.arange(len(hashes))
    return s.combine([np.where(place >= j, hashes[np.maximum(at - j, 0)], _EDGE) for j in range(n - 1, -1, -1)])


_START = s.combine([np.array([_EDGE])])


@dataclass
class Model:
    tokens: int
    types: int
    rare_share: float
    scale: float
    thresholds: np.ndarray
    weights: tuple[float, ...]
    edge: int = 0
    segments: list[int] = field(default_factory=list)
    tables: list[DataFrame] = field(default_factory=list)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": []}

    @cached_property
    def filters(self) -> list[np.ndarray]:
        """Bits of each order; none if they are larger than one broadcast."""
        if len(self.parts()) > 1:
            return []
        return [s.bloom_bits(t, 0, n) for t, n in zip(self.tables, self.segments)]

    @property
    def whole(self) -> float:
        return self.tokens + 0.1 * (self.types + 1)

    def levels(self, order: int, keys: np.ndarray, bits: np.ndarray | None = None, first: int = 0) -> np.ndarray:
        """Levels of distinct keys, by probes until one is missing; ``bits`` from segment ``first`` on hold the keys' segments."""
        bits = self.filters[order - 1] if bits is None else bits
        level = np.zeros(len(keys), np.int64)
        flat, alive = bits.reshape(-1), np.arange(len(keys))
        start = (s.bloom_segment(keys, self.segments[order - 1]) - first) * s.SEGMENT_BITS
        for i in range(1, len(self.thresholds)):
            if not len(alive):
                break
            a, b = s.bloom_steps(keys, i)
            for step in range(1, s.PROBES + 1):
                at = start + ((a + np.uint64(step) * b) >> s.PLACE_SHIFT).view(np.int64)
                there = (flat[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                if not there.all():
                    alive, keys, start, a, b = alive[there], keys[there], start[there], a[there], b[there]
            level[alive] = i
        return level

    def parts(self) -> list[list[tuple[int, int, int]]]:
        """(order, first segment, last) of what is broadcast at a time."""
        out, room = [[]], MOST_SEGMENTS
        for order, count in enumerate(self.segments, 1):
            first = 0
            while first < count:
                if not room:
                    out.append([])
                    room = MOST_SEGMENTS
                last = min(count, first + room)
                out[-1].append((order, first, last))
                room -= last - first
                first = last
        return out

    def log_probabilities(self, words: s.Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, log10 probability) of every token."""
        hashes, text, place = _sequence(words)

        def read(n: int, asked: np.ndarray) -> np.ndarray:
            keys, back = np.unique(_ngrams(hashes, place, n)[asked], return_inverse=True)
            return self.levels(n, keys)[back]

        return text, self.logs(place, read)

    def logs(self, place: np.ndarray, read: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        """log10 probability of every token; read: levels of the n-grams that end at the tokens asked for, by order."""
        low = np.r_[0, self.thresholds[:-1]].astype(float)
        high = np.r_[0, self.thresholds[1:] - 1].astype(float)
        middle = np.sqrt(low * high)
        before = None
        probability = np.zeros(0)
        for n in range(1, len(self.segments) + 1):
            # An n-gram can only be in the filter if the two n-grams inside it are.
            asked = np.ones(len(place), bool)
            if n > 1:
                asked = (before > 0) & (np.r_[False, before[:-1] > 0] | (place == 0))
                asked &= (place > 0) | (n == 2)
            level = np.zeros(len(place), np.int64)
            level[asked] = read(n, asked)
            if n == 1:
                known = (middle[level] * self.scale + 0.1) / self.whole
                probability = np.where(level > 0, known, self.rare_share)
                edge = self.edge
            else:
                # The history is the shorter n-gram that ends one token before.
                history = np.r_[0, before[:-1]]
                history[place == 0] = edge if n == 2 else 0
                found = history > 0
                ratio = np.minimum(1.0, low[level] / np.maximum(high[history], 1))
                weight = self.weights[n - 2]
                probability = np.where(found, (1 - weight) * probability + weight * ratio, probability)
            before = level
        return np.log10(probability)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# Parquet looks at sizes after 100 rows else, which may be a gigabyte; what is packed isn't packed again.
_LARGE_ROWS = {
    "compression": "none",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(1 << 24),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


def _stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """:func:`shared.materialize` with few rows in memory; the shuffle files of its steps go as soon as it is written."""
    settings = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH),
        "spark.sql.parquet.columnarReaderBatchSize": "16",
    }
    with _set(df.sparkSession, settings):
        return s.materialize(df, name, **options)


# Sorted keys travel as their differences, bytes of equal weight together.


def _pack(values: np.ndarray, kind: str = "<u8") -> bytes:
    planes = values.astype(kind).view(np.uint8).reshape(len(values), -1).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind: str = "<u8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n), dtype=np.uint64)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin, and the end."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, np.int64)


_PACKED = "part int, size int, keys binary, counts binary"


def _packed(part: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each run of equal parts; keys must ascend in it."""
    at = _runs(part)
    runs = list(zip(at[:-1], at[1:]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[at[:-1]], pa.int32()),
            pa.array(np.diff(at), pa.int32()),
            pa.array([_pack_keys(keys[a:b]) for a, b in runs], pa.binary()),
            pa.array([_pack(counts[a:b]) for a, b in runs], pa.binary()),
        ],
        ["part", "size", "keys", "counts"],
    )


def _unpacked(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    columns = [batch.column(c).to_pylist() for c in ("size", "keys", "counts")]
    for size, keys, counts in zip(*columns):
        yield _unpack_keys(keys, size), _unpack(counts, size).astype(np.int64)


def _group_of(keys: np.ndarray, segments: int) -> np.ndarray:
    # Numbers of 16 bits are sorted in linear time.
    return (s.bloom_segment(keys, segments) // GROUP).astype(np.uint16 if segments <= GROUP << 16 else np.int32)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


@dataclass
class _Chunk:
    """The tokens of several texts: their distinct hashes, which of them each token is, and how many each text has."""

    words: np.ndarray
    index: np.ndarray
    lengths: np.ndarray

    @classmethod
    def all_of(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield cls.at(batch, i)

    @classmethod
    def at(cls, rows: pa.RecordBatch | pa.Table, i: int) -> _Chunk:
        of = {c: rows.column(c)[i].as_py() for c in ("texts", "types", "size", "words", "tokens", "lengths")}
        parts = (("words", "types", "<u8"), ("tokens", "size", "<u4"), ("lengths", "texts", "<u4"))
        words, index, lengths = (_unpack(of[data], of[n], kind) for data, n, kind in parts)
        return cls(words, index, lengths.astype(np.int64))

    @cached_property
    def place(self) -> np.ndarray:
        return np.arange(len(self.index)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    @property
    def word_keys(self) -> np.ndarray:
        """Key of each distinct word as an n-gram of its own; different words have different ones."""
        return s.combine([self.words])

    def keys(self, n: int) -> np.ndarray:
        """Key of the n-gram that ends at each token."""
        out = np.empty(len(self.index), np.uint64)
        for start in range(0, len(out), RUN):
            # An n-gram reaches back to n - 1 tokens before.
            some = slice(max(0, start - n + 1), start + RUN)
            out[start : start + RUN] = _ngrams(self.words[self.index[some]], self.place[some], n)[start - some.start :]
        return out

    def asked(self, n: int) -> np.ndarray:
        """Distinct n-grams, sorted."""
        keys = np.sort(self.word_keys if n == 1 else self.keys(n))
        return keys[_runs(keys)[:-1]]


_CUT = "texts int, types int, size int, words binary, tokens binary, lengths binary"


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts cut into words, in chunks: what the other functions here take instead of texts, so that they cut none themselves."""
    return _cut(_keyed(docs, id_col, text_col))


def _is_cut(df: DataFrame) -> bool:
    return {"chunk", "tokens", "lengths"} <= set(df.columns)


def _cut(narrow: DataFrame) -> DataFrame:
    """A row for each ``CHUNK`` bytes of the column text, about, with the packed tokens and lists of the other columns."""
    others = [c for c in narrow.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in s.chunks(batches, "text", min(PIECE, CHUNK)):
            own = batch.column("text").nbytes
            if held and size + own > CHUNK:
                yield pack(held)
                held, size = [], 0
            words = s.Words(batch.column("text"))
            held.append((_sequence(words)[0], words.per_text + 1, batch.select(others)))
            size += own
        if held:
            yield pack(held)

    def pack(held: list[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]) -> pa.RecordBatch:
        hashes, lengths = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        coded = pa.array(hashes).dictionary_encode()
        words, index = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        counts = [pa.array([len(x)], pa.int32()) for x in (lengths, words, index)]
        packed = [pa.array([_pack(x, kind)]) for x, kind in ((words, "<u8"), (index, "<u4"), (lengths, "<u4"))]
        ends = pa.array([0, len(lengths)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays([x[2].column(c) for x in held])) for c in others]
        names = ["chunk", "texts", "types", "size", "words", "tokens", "lengths", *others]
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *counts, *packed, *lists], names)

    lists = "".join(f", {c} array<{narrow.schema[c].dataType.simpleString()}>" for c in others)
    return _stored(narrow.mapInArrow(run, f"chunk string, {_CUT}{lists}"), "texts", **_LARGE_ROWS)


def _tokens(cut: DataFrame) -> DataFrame:
    return cut.select("chunk", "texts", "types", "size", "words", "tokens", "lengths")


def _training(training: DataFrame) -> DataFrame:
    return _tokens(training if _is_cut(training) else _cut(training.select("text")))


def _counted(training: DataFrame) -> DataFrame:
    """(key, n) of the words in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _Chunk.all_of(batches):
            counts = np.bincount(chunk.index, minlength=len(chunk.words))
            yield pa.RecordBatch.from_arrays([pa.array(s.signed(chunk.word_keys)), pa.array(counts)], ["key", "n"])

    return training.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _training_keys(chunk: _Chunk, n: int) -> np.ndarray:
    # From the second order on, a mark before the text is one word of the n-gram at most.
    return chunk.keys(n) if n <= 2 else chunk.keys(n)[chunk.place > 0]


def _leveled(training: DataFrame, n: int, thresholds: np.ndarray, tokens: int) -> DataFrame:
    """Packed keys and levels of the n-grams in the training texts, and the sum of the levels, a row a bucket of keys."""
    buckets = max(1, -(-tokens // BUCKET))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for chunk in _Chunk.all_of(batches):
            held.append(_training_keys(chunk, n))
            count += len(held[-1])
            if count >= TOGETHER:
                yield distinct(held)
                held, count = [], 0
        if count:
            yield distinct(held)

    def distinct(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.concatenate(held)
        held.clear()
        keys.sort()
        at = _runs(keys)
        keys = keys[at[:-1]]
        return _packed(_bucket_of(keys, buckets), keys, np.diff(at))

    def add(sent: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate(x) for x in zip(*_unpacked(sent)))
        order = np.argsort(keys)
        keys = keys[order]
        at = _runs(keys)[:-1]
        level = np.searchsorted(thresholds[:-1], np.add.reduceat(counts[order], at), side="right")
        out = pa.Table.from_batches([_packed(np.zeros(len(at), np.int32), keys[at], level)])
        return out.append_column("held", pa.array([int(level.sum())], pa.int64()))

    sent = training.mapInArrow(send, _PACKED)
    return _stored(sent.groupBy("part").applyInArrow(add, f"{_PACKED}, held long"), "levels", **_LARGE_ROWS)


def _by_group(keys: np.ndarray, level: np.ndarray, segments: int) -> pa.RecordBatch:
    """Sorted keys and their levels, packed for the groups of segments."""
    group = _group_of(keys, segments)
    order = np.argsort(group, kind="stable")
    return _packed(group[order], keys[order], level[order])


def _filter(entries: DataFrame, segments: int) -> DataFrame:
    """(segment, bits) of a filter over the packed keys of each group of segments, a level's entries for each key."""

    def fill(key: tuple, sent: pa.Table) -> pa.Table:
        first = key[0].as_py() * GROUP
        last = min(segments, first + GROUP)
        flat = np.zeros((last - first) * s.SEGMENT_BITS, bool)
        for keys, level in _unpacked(sent):
            start = (s.bloom_segment(keys, segments) - first) * s.SEGMENT_BITS
            for salt in range(1, int(level.max(initial=0)) + 1):
                of = np.flatnonzero(level >= salt)
                for place in s.bloom_places(keys[of], salt):
                    flat[start[of] + place.astype(np.int64)] = True
        bits = np.packbits(flat.reshape(last - first, -1), axis=1, bitorder="little")
        return pa.table({"segment": pa.array(range(first, last), pa.int32()), "bits": [row.tobytes() for row in bits]})

    return _stored(entries.groupBy("part").applyInArrow(fill, "segment int, bits binary"), "filter", **_LARGE_ROWS)


def count_words(training: DataFrame) -> DataFrame:
    """(key, n) of every word and of the end mark in a table with the column text, or one of :func:`cut`."""
    with s.Scope() as scope:
        return scope.keep(_stored(_counted(_training(training)), "words"))


def train(training: DataFrame, words: DataFrame, base: float = BASE, weights: tuple[float, ...] = WEIGHTS) -> Model:
    """The model of a table with the column text, or one of :func:`cut`; words: its :func:`count_words`."""
    tokens, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    thresholds = [1]
    while thresholds[-1] <= tokens:
        thresholds.append(max(thresholds[-1] + 1, int(np.ceil(thresholds[-1] * base))))
    thresholds.append(thresholds[-1] * 2)
    thresholds = np.array(thresholds, np.int64)
    bounds = F.array(*[F.lit(int(t)) for t in thresholds[:-1]])
    level = F.size(F.filter(bounds, lambda t: t <= F.col("n")))
    low, high = np.r_[0, thresholds[:-1]].astype(float), np.r_[0, thresholds[1:] - 1].astype(float)
    middle = F.element_at(F.array(*[F.lit(float(x)) for x in np.sqrt(low * high)]), level + 1)
    guessed = words.agg(F.sum(middle)).first()[0]
    whole = tokens + 0.1 * (types + 1)
    model = Model(tokens, types, 0.1 / whole, tokens / (guessed or 1), thresholds, weights)
    with s.Scope() as outer:
        training = _training(training)
        texts = training.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
        model.edge = int((thresholds[:-1] <= texts).sum())
        for n in range(1, len(weights) + 2):
            with s.Scope() as scope:
                if n == 1:
                    leveled = words.select("key", level.alias("level"))
                    held = leveled.agg(F.coalesce(F.sum("level"), F.lit(0))).first()[0]
                else:
                    leveled = _leveled(training, n, thresholds, tokens)
                    held = leveled.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
                segments = s.segments_for(held)

                def route(batches: Iterator[pa.RecordBatch], n=n, segments=segments) -> Iterator[pa.RecordBatch]:
                    for batch in batches:
                        if n > 1:
                            yield from (_by_group(*pair, segments) for pair in _unpacked(batch))
                        else:
                            keys, level = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "level"))
                            order = np.argsort(keys.view(np.uint64))
                            yield _by_group(keys.view(np.uint64)[order], level[order], segments)

                model.segments.append(segments)
                model.tables.append(outer.keep(scope.keep(_filter(leveled.mapInArrow(route, _PACKED), segments))))
    return model


def _asked(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of distinct, sorted keys, and the keys' order by group: how a chunk asks and reads the answers."""
    group = _group_of(keys, segments)
    return group, np.argsort(group, kind="stable")


_QUESTION = "part int, copy int, chunk string, size int, keys binary"


def _question(chunk: str, part: np.ndarray, keys: np.ndarray, copies: int) -> pa.RecordBatch:
    """What a chunk asks each part; keys must ascend in a run of equal parts."""
    at = _runs(part)
    sent = [_pack_keys(keys[a:b]) for a, b in zip(at[:-1], at[1:])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[at[:-1]], pa.int32()),
            pa.array([zlib.crc32(chunk.encode()) % copies] * len(sent), pa.int32()),
            pa.array([chunk] * len(sent), pa.string()),
            pa.array(np.diff(at), pa.int32()),
            pa.array(sent, pa.binary()),
        ],
        ["part", "copy", "chunk", "size", "keys"],
    )


def _copied(table: DataFrame, copies: int) -> DataFrame:
    return table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _levels(chunks: DataFrame, model: Model, n: int) -> DataFrame:
    """(chunk, n, part, levels): for each chunk and group of segments the levels of its distinct n-grams, by key."""
    segments, table, model = model.segments[n - 1], model.tables[n - 1], replace(model, tables=[])
    groups = -(-segments // GROUP)
    # With many texts to a small filter, copies of a group share its questions.
    most = chunks.agg(F.coalesce(F.sum("types" if n == 1 else "size"), F.lit(0))).first()[0]
    copies = max(1, math.ceil(most / groups / ASKED))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("chunk").to_pylist()):
                keys = _Chunk.at(batch, i).asked(n)
                group, order = _asked(keys, segments)
                yield _question(name, group[order], keys[order], copies)

    def answer(key: tuple, bits: pa.Table, asked: pa.Table) -> pa.Table:
        first = key[0].as_py() * GROUP
        held = np.zeros((GROUP, s.SEGMENT_BITS // 8), np.uint8)
        for segment, row in zip(bits.column("segment").to_pylist(), bits.column("bits").to_pylist()):
            held[segment - first] = np.frombuffer(row, np.uint8)
        each = [(size, keys.as_py()) for size, keys in zip(asked.column("size").to_pylist(), asked.column("keys"))]
        # Common n-grams are asked for by many chunks and have the most levels.
        keys = np.concatenate([*(_unpack_keys(own, size) for size, own in each), np.zeros(0, np.uint64)])
        keys.sort()
        keys = keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]
        level = np.zeros(len(keys), np.uint8)
        for start in range(0, len(keys), TOGETHER >> 3):
            some = slice(start, start + (TOGETHER >> 3))
            level[some] = model.levels(n, keys[some], held, first)
        found = [_pack(level[np.searchsorted(keys, _unpack_keys(own, size))]) for size, own in each]
        return pa.table(
            {
                "chunk": asked.column("chunk"),
                "n": pa.array([n] * len(found), pa.int32()),
                "part": asked.column("part"),
                "size": asked.column("size"),
                "levels": pa.array(found, pa.binary()),
            }
        )

    asked = _tokens(chunks).mapInArrow(ask, _QUESTION)
    bits = _copied(table.withColumn("part", F.expr(f"cast(segment div {GROUP} as int)")), copies)
    by = ("part", "copy")
    answers = bits.groupBy(*by).cogroup(asked.groupBy(*by))
    schema = "chunk string, n int, part int, size int, levels binary"
    return _stored(answers.applyInArrow(answer, schema), "levels", **_LARGE_ROWS)


def _told(chunk: _Chunk, told: pa.Table, model: Model, n: int) -> np.ndarray:
    """Levels of a chunk's n-grams, from the answers of all groups."""
    keys = chunk.word_keys if n == 1 else chunk.keys(n)
    at = np.argsort(keys)
    keys = keys[at]
    runs = _runs(keys)
    _, order = _asked(keys[runs[:-1]], model.segments[n - 1])
    own = told.filter(pc.equal(told.column("n"), n)).sort_by("part")
    level = np.zeros(len(order), np.uint8)
    level[order] = np.concatenate(
        [_unpack(x, size) for size, x in zip(own.column("size").to_pylist(), own.column("levels").to_pylist())]
    )
    out = np.empty(len(keys), np.uint8)
    out[at] = np.repeat(level, np.diff(runs))
    return out[chunk.index] if n == 1 else out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row (a hash of id and text), n_tokens and score, the log10 probability, of each text; docs: texts or :func:`cut`."""
    with s.Scope() as scope:
        chunks = docs if _is_cut(docs) else cut(docs, id_col, text_col)
        kind = chunks.schema["id"].dataType.elementType.simpleString()
        orders = range(1, len(model.segments) + 1)
        told = reduce(DataFrame.unionByName, [_levels(chunks, model, n) for n in orders])
        model = replace(model, tables=[])

        def run(rows: pa.Table, told: pa.Table) -> pa.Table:
            ids, row = (rows.column(c).combine_chunks().flatten() for c in ("id", "row"))
            chunk = _Chunk.at(rows, 0)
            levels = [_told(chunk, told, model, n) for n in orders]
            scores = []
            ends = np.cumsum(chunk.lengths)
            texts = _runs((ends - 1) // RUN)
            for first, last in zip(texts[:-1], texts[1:]):
                some = slice(ends[first] - chunk.lengths[first], ends[last - 1])
                logs = model.logs(chunk.place[some], lambda n, asked, some=some: levels[n - 1][some][asked])
                own = chunk.lengths[first:last]
                scores.append(np.bincount(np.repeat(np.arange(len(own)), own), logs, len(own)))
            columns = [ids, row, pa.array(chunk.lengths), pa.array(np.concatenate(scores))]
            return pa.table(columns, ["id", "row", "n_tokens", "score"])

        scored = chunks.groupBy("chunk").cogroup(told.groupBy("chunk"))
        schema = f"id {kind}, row long, n_tokens long, score double"
        return scope.keep(_stored(scored.applyInArrow(run, schema), "scores"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        s.column(id_col).alias("id"),
        F.xxhash64(s.column(id_col), s.column(text_col)).alias("row"),
        s.column(text_col).alias("text"),
    )


def unigram_baseline(
    docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", exact: float = EXACT
) -> DataFrame:
    """row, n_known and base_score by exact word counts, and train_tokens; docs: texts or :func:`cut`."""
    tokens, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    whole = tokens + 0.1 * (types + 1)
    heavy = words.where(F.col("n") >= max(1.0, exact * tokens)).toPandas().sort_values("key")
    keys, counts = heavy["key"].to_numpy(np.int64), heavy["n"].to_numpy(np.int64)
    shipped = docs.sparkSession.sparkContext.broadcast((keys, counts))

    buckets = max(1, -(-types // BUCKET))

    def common(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are common ones, and how often these are met."""
        own = s.signed(own)
        keys, counts = shipped.value
        if not len(keys):
            return np.zeros(len(own), bool), np.zeros(len(own), np.int64)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        found = keys[at] == own
        return found, np.where(found, counts[at], 0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= TOGETHER:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys, n = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("key", "n"))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        return _packed(_bucket_of(keys[order], buckets), keys[order], n[order])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("chunk").to_pylist()):
                own = _Chunk.at(batch, i).word_keys
                keys = np.sort(own[~common(own)[0]])
                if len(keys):
                    yield _question(name, _bucket_of(keys, buckets), keys, copies)

    def answer(held: pa.Table, asked: pa.Table) -> pa.Table:
        pairs = [*_unpacked(held), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        keys, counts = (np.concatenate(x) for x in zip(*pairs))
        order = np.argsort(keys)
        # A count of 0 for what isn't there, after the last key.
        keys, counts = keys[order], np.append(counts[order], 0)
        found = []
        for size, own in zip(asked.column("size").to_pylist(), asked.column("keys")):
            own = _unpack_keys(own.as_py(), size)
            at = np.searchsorted(keys, own)
            at[np.searchsorted(keys, own, side="right") == at] = len(keys)
            found.append(_pack(counts[at]))
        columns = [*(asked.column(c) for c in ("chunk", "part", "size")), pa.array(found, pa.binary())]
        return pa.table(columns, ["chunk", "part", "size", "counts"])

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        chunk, told = _Chunk.at(rows, 0), told.sort_by("part")
        own = chunk.word_keys
        found, count = common(own)
        rest = np.flatnonzero(~found)
        if len(rest):
            sent = zip(told.column("size").to_pylist(), told.column("counts").to_pylist())
            count[rest[np.argsort(own[rest])]] = np.concatenate([_unpack(x, size).astype(np.int64) for size, x in sent])
        text, n = chunk.text, len(chunk.lengths)
        known = np.bincount(text, (count > 0)[chunk.index], n).astype(np.int64)
        base = np.bincount(text, np.log10((count + 0.1) / whole)[chunk.index], n)
        row = rows.column("row").combine_chunks().flatten()
        return pa.table([row, pa.array(known), pa.array(base)], ["row", "known", "base"])

    with s.Scope() as scope:
        chunks = docs if _is_cut(docs) else cut(docs, id_col, text_col)
        most = chunks.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
        copies = max(1, math.ceil(most / buckets / ASKED))
        by = ("part", "copy")
        held = _copied(words.select("key", "n").mapInArrow(send, _PACKED), copies).groupBy(*by)
        answers = held.cogroup(_tokens(chunks).mapInArrow(ask, _QUESTION).groupBy(*by))
        told = _stored(answers.applyInArrow(answer, "chunk string, part int, size int, counts binary"), "counts", **_LARGE_ROWS)
        told = chunks.select("row", *_tokens(chunks).columns).groupBy("chunk").cogroup(told.groupBy("chunk"))
        summed = told.applyInArrow(run, "row long, known long, base double").groupBy("row")
        summed = summed.agg(F.count("*").alias("copies"), F.sum("known").alias("known"), F.sum("base").alias("base"))
        return scope.keep(
            _stored(
                summed.select(
                    "row",
                    F.expr("known div copies").alias("n_known"),
                    (F.col("base") / F.col("copies")).alias("base_score"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                ),
                "baseline",
            )
        )
