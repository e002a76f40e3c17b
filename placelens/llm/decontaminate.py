"""Benchmark decontamination by template canonicalisation.

Words lose punctuation and case. A word with a digit, or a number word, becomes the placeholder for a number; a unit after a number
that for a unit; a capitalised word inside a sentence that for a name. Windows of ``window``
words of such templates are hash-joined between documents and benchmark items. An item of fewer words is one window of that
many; documents have windows of each such length as well. Templates need some plain words: at most half may be placeholders.
Names are known by case, which a copy may have changed, so each window is hashed a second time with names as plain
words (and a unit at its start, as the number before it may not be the item's); a hit of either kind counts. Where more than half would still be
placeholders, the second hash is that of the words themselves, so arithmetic and lists match verbatim.

Matches of a document with an item are put on diagonals (place in the document less place in the item): one
occurrence of the item is one diagonal. There a window with the item's own values matches by itself; in
the others every placeholder value of the item must go to one value of the document, or they are no re-parameterised
question and don't count. The document is a leak of the item if the windows that count cover at least ``coverage`` of
the item's windows, or of those that are templates.

The windows of all documents don't leave their task but for hits: hashes of the benchmark's windows, if at
most ``MOST_WINDOWS`` (64 MiB), are broadcast as a filter before the join; a larger benchmark is joined without it,
with the same result.

Edge cases: null and empty texts match nothing, items without words neither; repeated items and rows
give the same pair once; rows that share an id are one document; with an empty table there are no pairs; a null id is an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm import shared as s

WINDOW = 8
COVERAGE = 0.5
MOST_WINDOWS = 1 << 23

#: Units that may follow a number, and numbers in words.
UNITS = (
    "mm cm m km g kg mg t ml l s ms min h inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute "
    "minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degrees"
).split()
NUMBERS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()

_DROPPED = np.ones(256, bool)
_DROPPED[48:58] = _DROPPED[65:91] = _DROPPED[97:123] = _DROPPED[128:] = False
_PLACEHOLDERS = {1: np.uint64(0xA1), 2: np.uint64(0xB2), 3: np.uint64(0xC3)}


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(s.Words(pa.array(words), dropped=_DROPPED).hash)


_UNITS, _NUMBERS = _hashes(UNITS), _hashes(NUMBERS)


def _kinds(w: s.Words) -> np.ndarray:
    """0 for a plain word, 1 number, 2 unit, 3 name."""
    digits = np.r_[0, np.cumsum((w.data >= 48) & (w.data < 58))]
    number = (digits[w.end] > digits[w.start]) | np.isin(w.hash, _NUMBERS)
    unit = np.isin(w.hash, _UNITS) & np.r_[False, number[:-1]] & (w.place > 0)
    upper = (w.data >= 65) & (w.data < 91)
    uppers = np.r_[0, np.cumsum(upper)]
    before = np.r_[0, w.end[:-1]]
    stops = np.r_[0, np.cumsum(np.isin(w.data, np.frombuffer(b".!?:;|\n\"", np.uint8)))]
    inside = (w.place > 0) & (stops[w.start] == stops[before])
    name = upper[w.start] & (uppers[w.end] - uppers[w.start] == 1) & (w.end - w.start > 1) & inside
    return np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0)))


class _Windows:
    """Windows of a batch's templates: text, first word and hash; and what fills each placeholder."""

    def __init__(self, texts: pa.Array, window: int, lengths: list[int] | None = None):
        """Windows of all ``lengths``; if not given, of ``window`` words or a shorter text's own."""
        w = self.words = s.Words(texts, dropped=_DROPPED)
        self.kind = _kinds(w) if w.count else np.zeros(0, np.int64)
        self.window = window
        typed = w.hash.copy()
        for kind, mark in _PLACEHOLDERS.items():
            typed[self.kind == kind] = mark
        nameless = np.where(self.kind == 3, w.hash, typed)
        own = np.minimum(w.per_text, window)[w.text]
        sizes = [own] if lengths is None else [np.full(w.count, n) for n in lengths]
        starts = [np.flatnonzero(w.place + n <= w.per_text[w.text]) for n in sizes]
        at = np.concatenate(starts)
        end = at + np.concatenate([n[a] for n, a in zip(sizes, starts)])
        names, held = np.r_[0, np.cumsum(self.kind == 3)], np.r_[0, np.cumsum(self.kind > 0)]
        named, unit = names[end] - names[at], self.kind[at] == 2
        filled = held[end] - held[at]
        # With names as placeholders, and where that makes a difference, without, or without any.
        first = 2 * filled <= end - at
        second = (named > 0) | unit | ~first
        real = (2 * (filled - named - unit) > end - at)[second]
        n_first = int(first.sum())
        self.at, self.end = np.r_[at[first], at[second]], np.r_[end[first], end[second]]
        self.named = np.arange(len(self.at)) < n_first
        self.real = np.r_[np.zeros(n_first, bool), real]
        self.text = w.text[self.at]
        self.template = np.r_[np.ones(n_first, bool), first[second]]
        self.counted = self.named | ~self.template  # each place once
        unnamed = self._hash(nameless, self.at[n_first:], self.end[n_first:], w.hash)
        unnamed[real] = self._hash(w.hash, self.at[self.real], self.end[self.real])
        self.hash = np.r_[self._hash(typed, self.at[:n_first], self.end[:n_first]), unnamed]

    def _hash(self, token: np.ndarray, at: np.ndarray, end: np.ndarray, units: np.ndarray | None = None) -> np.ndarray:
        """Hashes of windows; ``units`` are the tokens of units at their start."""
        padded = np.r_[token, np.full(self.window, s._PAD)]
        parts = [np.where(at + j < end, padded[at + j], s._PAD) for j in range(self.window)]
        if units is not None:
            parts[0] = np.where(self.kind[at] == 2, units[at], parts[0])
        return s.combine(parts)

    def values(self, i: int, held: bool) -> list[str]:
        """What fills the placeholders of a window, or else (not ``held``) the numbers, units and names that are plain in it."""
        w, named, at = self.words, self.named[i], self.at[i]
        some = not self.real[i]
        return [
            w.data[w.start[j] : w.end[j]].tobytes().decode(errors="replace").lower()
            for j in range(at, self.end[i])
            if self.kind[j] and held == (some and (named or self.kind[j] == 1 or (self.kind[j] == 2 and j > at)))
        ]


def _windows(
    table: DataFrame, id_col: str, text_col: str, window: int, lengths: list[int] | None = None, wanted=None
) -> DataFrame:
    """id, place, total, templates, template, length, hash, slots and other values (``fixed``) of the windows, of those in the broadcast ``wanted`` if given."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = _Windows(batch.column("text"), window, lengths)
        picked = np.arange(len(found.at))
        if wanted is not None:
            hashes = wanted.value
            near = np.minimum(np.searchsorted(hashes, found.hash), max(0, len(hashes) - 1))
            picked = np.flatnonzero(hashes[near] == found.hash) if len(hashes) else picked[:0]
        if not len(picked):
            return None
        total = np.bincount(found.text[found.counted], minlength=batch.num_rows)
        templates = np.bincount(found.text[found.named], minlength=batch.num_rows)
        text = found.text[picked]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(text)),
                pa.array(found.words.place[found.at[picked]]),
                pa.array(total[text]),
                pa.array(templates[text]),
                pa.array(found.template[picked]),
                pa.array((found.end - found.at)[picked]),
                pa.array(s.signed(found.hash[picked])),
                pa.array([found.values(i, True) for i in picked], pa.list_(pa.string())),
                pa.array([found.values(i, False) for i in picked], pa.list_(pa.string())),
            ],
            ["id", "place", "total", "templates", "template", "length", "hash", "slots", "fixed"],
        )

    narrow = table.select(s.column(id_col).alias("id"), s.column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, place long, total long, templates long, template boolean, length long, hash long"
    return s.map_chunks(narrow, "text", run, f"{schema}, slots array<string>, fixed array<string>")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs of document and item: id, item, n_windows of the item, n_matched, and whether it is ``verbatim``."""
    items = s.materialize(_windows(benchmark, item_col, item_text_col, window), "items")
    distinct = items.select("hash").distinct()
    lengths = sorted({window, *[r.length for r in items.select("length").distinct().collect()]})
    wanted = None
    if distinct.count() <= MOST_WINDOWS:
        hashes = np.sort(distinct.toPandas()["hash"].to_numpy(np.int64).view(np.uint64))
        wanted = docs.sparkSession.sparkContext.broadcast(hashes)
    found = _windows(docs, id_col, text_col, window, lengths, wanted).select("id", "place", "hash", "slots")
    # A window that an item has twice, or that equal items share, is matched at each place.
    sides = items.select(
        "hash", F.col("id").alias("item"), F.col("place").alias("at"), "total", "templates", "template", F.col("slots").alias("given"), "fixed"
    )
    # A value that is a plain word in the window is equal in the document.
    same = F.transform("fixed", lambda v: F.struct(v.alias("given"), v.alias("slots")))
    matched = found.join(sides, "hash").select(
        "id",
        "item",
        "at",
        "total",
        "templates",
        "template",
        (F.col("place") - F.col("at")).alias("diagonal"),
        F.concat(F.arrays_zip("given", "slots"), same).alias("values"),
    )
    own = F.forall("values", lambda v: v["given"] == v["slots"])
    matched = matched.withColumn("own", own)
    at, templates = F.col("at"), F.when(F.col("template"), F.col("at"))
    occurrences = (
        matched.groupBy("id", "item", "diagonal")
        .agg(
            F.max("total").alias("total"),
            F.max("templates").alias("templates"),
            F.every("own").alias("own"),
            F.collect_set(at).alias("at"),
            F.collect_set(templates).alias("template_at"),
            F.collect_set(F.when(F.col("own"), at)).alias("own_at"),
            F.collect_set(F.when(F.col("own"), templates)).alias("own_template_at"),
            F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("own"), F.col("values"))))).alias("values"),
        )
        .withColumn("consistent", F.size(F.array_distinct("values.given")) == F.size("values"))
    )
    counted = lambda all_, own_: F.when(F.col("consistent"), F.col(all_)).otherwise(F.col(own_))
    pairs = occurrences.groupBy("id", "item").agg(
        F.max("total").alias("n_windows"),
        F.max("templates").alias("templates"),
        F.size(F.array_distinct(F.flatten(F.collect_set(counted("template_at", "own_template_at"))))).alias("n_templates"),
        F.size(F.array_distinct(F.flatten(F.collect_set(counted("at", "own_at"))))).cast("long").alias("n_matched"),
        F.coalesce(F.every(F.when(F.col("consistent"), F.col("own"))), F.lit(False)).alias("verbatim"),
    )
    most = (F.col("n_matched") >= coverage * F.col("n_windows")) | (
        (F.col("templates") > 0) & (F.col("n_templates") >= coverage * F.col("templates"))
    )
    return pairs.where(most).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows", "n_matched", "verbatim"
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item; all columns stay."""
    found = lambda: leaks(docs, benchmark, id_col, text_col, **options).select(s.column(id_col).alias("id")).distinct()
    bad = s.materialize_alone(found, "leaks")
    name = s.free_name(docs, "_id")
    return docs.join(bad.withColumnRenamed("id", name), s.column(id_col).eqNullSafe(F.col(name)), "left_anti")
