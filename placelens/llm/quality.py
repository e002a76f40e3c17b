"""Quality classifier: naive Bayes support vector machine over n-gram indicators.

A text's indicators are hashed n-grams (1 to 3) of word shapes, a shape being the kinds of characters a word has in
order and whether it repeats the word before, and of lower-cased words (1 and 2). Each indicator is scaled by
the log ratio of its smoothed shares in the two classes, rows are scaled to length 1, and a linear
hinge-loss model is fitted by dual coordinate descent.

Class counts come from all labelled training rows: texts move once to their labels, and each task gives the sums of its features.
The model itself is fitted in one task on at most ``sample`` ids with a label, those with the smallest hash (of several texts with
an id the greatest); weights are ``features`` doubles. Scoring is one pass over the texts.

score = 1 / (1 + exp(-2 * margin)), so 0.5 is the separating plane.

Edge cases: null and empty texts have the bias as their margin; a label other than 0 and 1, and ids with
both labels, are left out of training; with no labels or one class alone each score is 0.5 and each prediction 1; repeated rows score
alike; a very long text is read whole, in one piece; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.llm import shared as s

FEATURES = 1 << 16
SAMPLE = 8000
EPOCHS = 12
COST = 4.0

_KIND = np.full(256, 3, np.uint8)  # other signs
_KIND[97:123] = 0
_KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
for _b in b"!?.,;:|*#%&$@/<>{}=_\"'()-":
    _KIND[_b] = 4 + _b % 60


def _shapes(words: s.Words) -> np.ndarray:
    """A hash of each word's run of character kinds, and of whether it is the word before again."""
    kinds = _KIND[words.data]
    within = np.zeros(len(kinds) + 1, np.int64)
    np.add.at(within, words.start, 1)
    np.add.at(within, words.end, -1)
    inside = np.cumsum(within[:-1]) > 0
    at = np.flatnonzero(inside)
    begins = np.zeros(len(kinds), bool)
    begins[words.start] = True
    turns = np.r_[True, kinds[at][1:] != kinds[at][:-1]] | begins[at]
    at = at[turns]
    starts = np.flatnonzero(begins[at])
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    marks = s.mix(kinds[at].astype(np.uint64) * np.uint64(1009) + np.minimum(place, 8).astype(np.uint64))
    shape = np.add.reduceat(marks, starts)
    again = np.r_[False, words.hash[1:] == words.hash[:-1]] & (words.place > 0)
    return s.mix(shape + again.astype(np.uint64))


def indicators(texts: pa.Array, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every distinct indicator, in that order."""
    words = s.Words(texts)
    if not words.count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shapes = _shapes(words)
    found = []
    at = np.arange(words.count)
    for kind, base, longest in ((1, shapes, 3), (2, words.hash, 2)):
        for n in range(1, longest + 1):
            parts = [np.where(words.place >= j, base[np.maximum(at - j, 0)], s._PAD) for j in range(n)]
            found.append(s.combine(parts) ^ s.mix(np.full(1, 10 * kind + n, np.uint64)))
    keys = (np.concatenate(found) % np.uint64(features)).astype(np.int64)
    both = np.unique(np.tile(words.text, len(found)) * features + keys)
    return both // features, both % features


def fit_dual(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over rows of indicators, by dual coordinate descent."""
    n = len(rows)
    weights, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(n)
    values = []
    for r in rows:
        v = ratio[r]
        size = np.sqrt((v * v).sum())
        values.append(v / size if size else v)
    squares = np.array([(v * v).sum() + 1.0 for v in values])
    per_class = {y: n / (2.0 * max(1, (labels == y).sum())) for y in (-1.0, 1.0)}
    bound = np.array([cost * per_class[y] for y in labels])
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for i in order.permutation(n):
            y, r, v = labels[i], rows[i], values[i]
            gradient = y * (weights[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / squares[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                weights[r] += step * v
                bias += step
                alpha[i] = new
    return weights, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    features: int = FEATURES,
    sample: int = SAMPLE,
    epochs: int = EPOCHS,
    cost: float = COST,
) -> tuple[np.ndarray, float]:
    """Bias, and weights (times the ratios) over squared ratios, from the documents that have a label."""
    label = s.column(label_col)
    known = (
        labels.where(label.isin(0, 1)).groupBy(s.column(id_col).alias("id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").select("id", "label")
    )
    narrow = docs.select(s.column(id_col).alias("id"), s.column(text_col).alias("text"))

    def tally(batches):
        counts, sizes = np.zeros((2, features), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for chunk in s.chunks([batch], "text"):
                good = chunk.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
                sizes += np.bincount(good, minlength=2)
                text, feature = indicators(chunk.column("text"), features)
                for y in (0, 1):
                    counts[y] += np.bincount(feature[good[text] == y], minlength=features)
        seen = np.flatnonzero(counts.any(axis=0))
        rows = np.r_[seen, -1], np.r_[counts[0][seen], sizes[0]], np.r_[counts[1][seen], sizes[1]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["feature", "bad", "good"])

    # Texts move once, to their labels, which grow with the corpus and so are never broadcast; what leaves a task are
    # its own sums. Feature -1 counts rows.
    sums = (
        narrow.join(known.hint("merge"), "id").select("label", "text").mapInArrow(tally, "feature long, bad long, good long")
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    )
    rows, counts = sums[sums.feature < 0], sums[sums.feature >= 0]
    sizes = int(rows.bad.sum()), int(rows.good.sum())
    if not all(sizes):
        return np.zeros((2, features)), 0.0
    good, bad = np.zeros(features), np.zeros(features)
    good[counts.feature], bad[counts.feature] = counts.good, counts.bad
    ratio = np.log((good + 1) / (sizes[1] + 2)) - np.log((bad + 1) / (sizes[0] + 2))
    # Ids first, so that the texts of at most ``sample`` ids are moved.
    ids = known.join(narrow.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = s.materialize(ids, "picked")
    picked = narrow.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.max("text").alias("text"))

    def fit(batches):
        rows, given = [], []
        for whole in batches:
            for batch in s.chunks([whole], "text"):
                given.append(batch.column("label").to_numpy(zero_copy_only=False))
                text, feature = indicators(batch.column("text"), features)
                rows += np.split(feature, np.searchsorted(text, np.arange(1, batch.num_rows)))
        if rows:
            weights, bias = fit_dual(rows, np.where(np.concatenate(given) == 1, 1.0, -1.0), ratio, cost, epochs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(weights * ratio).tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"]
            )

    # The order of the rows decides the fit's path, so it is fixed.
    ordered = picked.coalesce(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "label")
    row = ordered.mapInArrow(fit, "weights binary, bias double").first()
    s.release(chosen)
    return np.stack([np.frombuffer(row.weights, np.float64), ratio * ratio]), row.bias


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """id, the ``extra`` columns, score and predicted of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        margin = margins(batch.column("text"), *shipped.value)
        points = 1.0 / (1.0 + np.exp(-2.0 * margin))
        kept = [batch.column(n) for n in names]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(points), pa.array((points >= 0.5).astype(np.int32))], [*names, "score", "predicted"]
        )

    narrow = docs.select(s.column(id_col).alias("id"), *extra, s.column(text_col).alias("text"))
    schema = narrow.drop("text").schema.add("score", "double").add("predicted", "integer")
    names = [f.name for f in schema.fields[:-2]]
    return s.map_chunks(narrow, "text", run, schema)


def margins(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Margins of texts; ``weights[0]`` are for the indicators, ``weights[1]`` their squared scale."""
    text, feature = indicators(texts, weights.shape[-1])
    total = np.bincount(text, weights[0][feature], len(texts))
    size = np.sqrt(np.bincount(text, weights[1][feature], len(texts)))
    return np.divide(total, size, out=np.zeros(len(texts)), where=size > 0) + bias


def keep_good(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``; all columns stay."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for batch in s.chunks([whole], text_col):
                margin = margins(batch.column(text_col), *shipped.value)
                yield batch.filter(pa.array(1.0 / (1.0 + np.exp(-2.0 * margin)) >= least))

    return docs.mapInArrow(run, docs.schema)
