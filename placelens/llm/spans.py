"""Substring deduplication by sliding sentence spans.

A text is cut into sentences after a stop before white space, and at line ends. Commas, colons and semicolons are stops as well: a
passage that was put inside a sentence is then found but for a few words at its edges. A sentence of more
than ``LONG`` words is cut further, after about a fourth of its words: those whose hash together with the
word before says so, and those equal to the word before. So equal passages are cut alike in whatever sentence
they stand, and more than 50 words that repeat hold two whole pieces of at least 20 words. From every sentence a span runs over the fewest sentences that are at least ``sentences`` and hold at least ``words``
words; equal words give equal spans wherever they stand. Every span is hashed. The first place of a
hash, by id and then place in the text, stays; sentences that any other place of it covers are
removed, all at once. Bytes that stay are unchanged, and so is a text with nothing to remove.

Spans that only one document has never leave their partition's sums; a document sends each of its spans
once. A span of very many documents is summed before the shuffle; where its documents are told, both
sides of the join are plain shuffles, which adaptive execution splits.

Edge cases: a null text stays null, an empty one empty; a text with fewer sentences or words than a
span stays; rows that are equal in id and text count as one document and get the same result; a null id
comes first; other columns are kept, also with names like the result's; a very long text is read whole, in one piece; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm import shared as s

SENTENCES, WORDS = 2, 20
STOPS = b".!?,;:"
LONG, CUT = 16, 4


class _Sentences:
    """Sentences of a batch and, for every sentence that begins a span, its last sentence and hash."""

    def __init__(self, texts: pa.Array, sentences: int, least_words: int):
        w = self.words = s.Words(texts, lower=False)
        if not w.count:
            self.count, self.at, self.last, self.hash = 0, *[np.zeros(0, np.int64)] * 3
            self.text = self.at
            return
        stop = np.isin(w.data[w.end - 1], np.frombuffer(STOPS, np.uint8))
        lines = np.r_[0, np.cumsum(w.data == 10)]
        broken = np.r_[lines[w.start[1:]] > lines[w.end[:-1]], True]
        final = np.r_[w.text[1:] != w.text[:-1], True]
        ends = stop | broken | final
        first = np.flatnonzero(np.r_[True, ends[:-1]])
        length = np.diff(np.r_[first, w.count])
        before = np.r_[np.zeros(1, np.uint64), w.hash[:-1]]
        inner = np.arange(w.count) > np.repeat(first, length)
        chosen = (w.hash == before) | (s.mix(w.hash ^ s.mix(before)) % np.uint64(CUT) == 0)
        ends |= (np.repeat(length, length) > LONG) & inner & chosen
        first = np.flatnonzero(np.r_[True, ends[:-1]])
        self.count = len(first)
        self.start = w.start[first]
        self.text = w.text[first]
        n_words = np.diff(np.r_[first, w.count])
        place = np.arange(w.count) - np.repeat(first, n_words)
        own = np.add.reduceat(s.mix(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first)
        upto = np.r_[0, np.cumsum(n_words)]
        at = np.arange(self.count)
        enough = np.searchsorted(upto, upto[:-1] + least_words) - 1
        last = np.maximum(enough, at + sentences - 1)
        whole = last < self.count
        whole[whole] = self.text[last[whole]] == self.text[at[whole]]
        self.at, self.last = at[whole], last[whole]
        length = self.last - self.at + 1
        total = length.astype(np.uint64)
        for j in range(int(length.max()) if len(length) else 0):
            inside = length > j
            total[inside] += s.mix(own[self.at[inside] + j] ^ s.mix(np.full(1, j + 1, np.uint64)))
        self.hash = s.mix(total)


def _spans(docs: DataFrame, id_col: str, text_col: str, row: str, sentences: int, words: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = _Sentences(batch.column("text"), sentences, words)
        text = found.text[found.at] if found.count else found.at
        if not len(text):
            return None
        order = np.lexsort((found.hash, text))
        text, hashes = text[order], found.hash[order]
        new = np.r_[True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])]
        text = pa.array(text[new])
        return pa.RecordBatch.from_arrays(
            [pa.array(s.signed(hashes[new])), batch.column("id").take(text), batch.column("row").take(text)],
            ["span", "id", "row"],
        )

    narrow = docs.select(s.column(id_col).alias("id"), s.column(row).alias("row"), s.column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return s.map_chunks(narrow, "text", run, f"span long, id {kind}, row long")


def drop_repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: int = SENTENCES,
    words: int = WORDS,
    removed_col: str = "n_removed",
) -> DataFrame:
    """``docs`` with the text less its repeated sentences; ``removed_col`` counts those, if given."""
    row, gone = s.free_name(docs, "_row"), s.free_name(docs, "_gone")
    keyed = docs.withColumn(row, F.xxhash64(s.column(id_col), s.column(text_col)))
    spans = _spans(keyed, id_col, text_col, row, sentences, words)
    place = F.struct("id", "row")
    repeated = s.materialize(
        spans.groupBy("span").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
        .select("span", F.col("first.row").alias("kept")),
        "repeated",
    )
    lists = s.materialize(
        spans.select("span", "row")
        .join(repeated, "span")
        .where("row <> kept")
        .groupBy("row")
        .agg(F.collect_set("span").alias("gone")),
        "gone",
    ).select(F.col("row").alias(row), F.col("gone").alias(gone))
    s.release(repeated)
    joined = keyed.join(lists, row, "left").drop(row)
    extra = [s.free_name(docs, removed_col)] if removed_col else []
    schema = docs.schema
    for name in extra:
        schema = type(schema)(list(schema.fields)).add(name, "long")
    names = docs.columns

    def run(batches):
        for whole in batches:
            for batch in s.chunks([whole], text_col):
                text, count = _cut(batch.column(text_col), batch.column(gone), sentences, words)
                arrays = [text if n == text_col else batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(count) for _ in extra]], [*names, *extra])

    return joined.mapInArrow(run, schema)


def _cut(texts: pa.Array, gone: pa.Array, sentences: int, words: int) -> tuple[pa.Array, np.ndarray]:
    """The texts less the sentences that the spans in ``gone``, or earlier equal spans of the text, cover."""
    found = _Sentences(texts, sentences, words)
    removed = np.zeros(len(texts), np.int64)
    if not found.count or not len(found.at):
        return texts.cast(pa.string()), removed
    text = found.text[found.at]
    # Spans whose hash the text has already had.
    order = np.lexsort((found.at, found.hash, text))
    again = np.zeros(len(order), bool)
    again[order[1:]] = (found.hash[order[1:]] == found.hash[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    lengths = pa.compute.fill_null(pa.compute.list_value_length(gone), 0).to_numpy(zero_copy_only=False)
    if lengths.sum():
        values = gone.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        owner = np.repeat(np.arange(len(texts)), lengths).astype(np.uint64)
        listed = np.sort(s.mix(values ^ s.mix(owner)))
        asked = s.mix(found.hash ^ s.mix(text.astype(np.uint64)))
        at = np.minimum(np.searchsorted(listed, asked), len(listed) - 1)
        again |= listed[at] == asked
    change = np.zeros(found.count + 1, np.int64)
    np.add.at(change, found.at[again], 1)
    np.add.at(change, found.last[again] + 1, -1)
    covered = np.cumsum(change[:-1]) > 0
    removed = np.bincount(found.text[covered], minlength=len(texts)).astype(np.int64)
    if not removed.any():
        return texts.cast(pa.string()), removed
    data, offsets = found.words.data, found.words.offsets
    end = np.r_[found.start[1:], len(data)]
    end = np.minimum(end, offsets[found.text + 1])
    out = texts.to_pylist()
    edges = np.searchsorted(found.text, np.arange(len(texts) + 1))
    for i in np.flatnonzero(removed):
        own = np.arange(edges[i], edges[i + 1])
        pieces = [data[offsets[i] : found.start[own[0]]].tobytes()]
        pieces += [data[found.start[j] : end[j]].tobytes() for j in own[~covered[own]]]
        out[i] = b"".join(pieces).decode()
    return pa.array(out, pa.string()), removed
