"""Toxicity from class-conditional Kneser-Ney models of words.

Words are spelled by bytes: a word's probability is the product over its bytes, and an end mark, of what follows the seven bytes
before in the word. Two interpolated Kneser-Ney models, one of toxic and one of ordinary texts, have their own counts of
these eight-byte runs; all shorter runs back off to one distribution from the continuation counts of both classes together. So an
expression that neither class has says nothing, and a rare one only as much as its counts carry:

    P_c(x | h) = (max(c_c(h x) - D, 0) + D * T_c(h) * P(x | h')) / c_c(h)         P(x | h') where c_c(h) is 0
    P(x | h)   = (max(t(h x) - D, 0) + D * T(h) * P(x | h')) / t(h)               t: how many different bytes stand before

A passage of ``window`` words is judged by the difference of its log-likelihoods, each normalised by the passage's length in bytes; a text by
its most toxic passage, all passages of the whole text being read. A logistic curve over that, fitted on passages of texts that the
models had not seen (three folds), gives the score; at 0.5 either class is as likely.

The models are fitted in one task on at most ``sample`` labelled texts of each class, those with the smallest hash of the id. What
is shipped is a number for each eight-byte run and each history met, and two of the curve. Scoring is one pass over the texts.

Edge cases: a null or empty text, or one without words, has a difference of 0; a label other than 0 and 1, and ids with both
labels, are left out; of several texts with one id the greatest is learned; without texts of both classes every score is 0.5 and every
prediction 1; repeated rows score alike; a very long text is read whole, in one piece; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.llm import shared as s

ORDER = 8  # bytes that fit a key
SAMPLE = 8000
WINDOW = 2
FOLDS = 3
SYMBOLS = 257.0
_END = 0x20  # no word holds a space


def spelled(words: s.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, run) of every byte of the words at these places and of their end marks; a run is the byte and the seven before."""
    length = words.end[at] - words.start[at] + 1
    owner = np.repeat(np.arange(len(at)), length)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    source = words.start[at][owner] + place
    letters = s._LOWER[words.data[np.minimum(source, len(words.data) - 1)]] if len(owner) else np.zeros(0, np.uint8)
    letters = np.where(place == length[owner] - 1, _END, letters).astype(np.uint64)
    runs = letters.copy()
    for j in range(1, ORDER):
        before = np.where(place >= j, np.roll(letters, j), 0).astype(np.uint64)
        runs |= before << np.uint64(8 * j)
    return owner, runs


def _distinct(words: s.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each different word, and for every word which of them it is."""
    _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    return first, back


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    kept, back = np.unique(keys, return_inverse=True)
    return kept, np.bincount(back, counts, len(kept)).astype(np.int64)


def _looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The values of the asked keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class _Counts:
    """Counts of runs, with sums and numbers of different followers of their histories."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts, self.discount = keys, counts, _discount(counts)
        self.histories, back = np.unique(keys >> np.uint64(8), return_inverse=True)
        self.totals = np.bincount(back, counts, len(self.histories))
        self.followers = np.bincount(back, minlength=len(self.histories))

    def rest(self, histories: np.ndarray) -> np.ndarray:
        """The share that the shorter history gets; 1 for a history that has no counts."""
        total = _looked_up(self.histories, self.totals, histories)
        return np.where(total > 0, self.discount * _looked_up(self.histories, self.followers, histories) / np.maximum(total, 1), 1.0)

    def probability(self, runs: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        total = _looked_up(self.histories, self.totals, runs >> np.uint64(8))
        own = np.maximum(_looked_up(self.keys, self.counts, runs) - self.discount, 0) / np.maximum(total, 1)
        return own + self.rest(runs >> np.uint64(8)) * shorter


def _masked(runs: np.ndarray, order: int) -> np.ndarray:
    return runs & np.uint64((1 << 8 * order) - 1)


def _shared(runs: np.ndarray) -> list[_Counts]:
    """Continuation counts of the orders below the highest, from the runs of both classes, shortest first."""
    orders, longer = [], runs
    for order in range(ORDER - 1, 0, -1):
        keys, counts = np.unique(_masked(longer, order), return_counts=True)
        orders.append(_Counts(keys, counts))
        longer = keys
    return orders[::-1]


@dataclass
class Model:
    """Log ratios toxic to ordinary: of runs that a class has, and of what the histories leave for others; slope and middle of the curve."""

    runs: np.ndarray
    ratio: np.ndarray
    histories: np.ndarray
    left: np.ndarray
    slope: float = 0.0
    middle: float = 0.0
    window: int = WINDOW

    def of_runs(self, runs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
        return np.where(self.runs[at] == runs, self.ratio[at], _looked_up(self.histories, self.left, runs >> np.uint64(8)))

    def differences(self, texts: pa.Array) -> np.ndarray:
        """For each text, of its most toxic passage: the difference of the length-normalised log-likelihoods."""
        words = s.Words(texts)
        if not words.count or not len(self.runs):
            return np.zeros(words.texts)
        first, back = _distinct(words)
        owner, runs = spelled(words, first)
        asked, again = np.unique(runs, return_inverse=True)
        of_word = np.bincount(owner, self.of_runs(asked)[again], len(first))[back]
        # A passage ends at each word; the first ones of a text are shorter.
        begin = np.maximum(np.arange(words.count) + 1 - self.window, words.first[words.text])
        upto, length = np.r_[0.0, np.cumsum(of_word)], np.r_[0, np.cumsum(words.end - words.start + 1)]
        mean = (upto[1:] - upto[begin]) / (length[1:] - length[begin])
        most = np.full(words.texts, -np.inf)
        np.maximum.at(most, words.text, mean)
        return np.where(words.per_text > 0, most, 0.0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (self.differences(texts) - self.middle), -30, 30)))


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all words of the texts, and their counts."""
    words = s.Words(texts)
    if not words.count:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first, back = _distinct(words)
    owner, runs = spelled(words, first)
    return summed(runs, np.bincount(back)[owner])


def conditional(toxic: tuple[np.ndarray, np.ndarray], ordinary: tuple[np.ndarray, np.ndarray], window: int = WINDOW) -> Model:
    """Log ratios of the two models, from the (runs, counts) of each class."""
    runs = np.union1d(toxic[0], ordinary[0])
    shorter = np.full(len(runs), 1 / SYMBOLS)
    for order, counts in enumerate(_shared(runs), 1):
        shorter = counts.probability(_masked(runs, order), shorter)
    one, other = _Counts(*toxic), _Counts(*ordinary)
    ratio = np.log(one.probability(runs, shorter)) - np.log(other.probability(runs, shorter))
    histories = np.unique(runs >> np.uint64(8))
    return Model(runs, ratio, histories, np.log(one.rest(histories)) - np.log(other.rest(histories)), window=window)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of labels over x, each class with half of the weight."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    center, spread = x.mean(), x.std() or 1.0
    z = np.c_[np.ones(len(x)), (x - center) / spread]
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        gradient = z.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
    slope = max(beta[1], 1e-6) / spread
    return float(slope), float(center - beta[0] / slope)


def fitted(parts: list[tuple[int, int, pa.Array]], window: int) -> Model:
    """The model of texts given as (label, fold, texts)."""

    def of(label: int, out: int) -> tuple[np.ndarray, np.ndarray]:
        own = [counts[i] for i, (y, fold, _) in enumerate(parts) if y == label and fold != out]
        return summed(*(np.concatenate(x) for x in zip(*own, strict=True))) if own else counted(pa.array([], pa.string()))

    counts = [counted(texts) for _, _, texts in parts]
    x, y = [], []
    for out in range(FOLDS):
        model = conditional(of(1, out), of(0, out), window)
        for label, fold, texts in parts:
            if fold == out:
                x.append(model.differences(texts))
                y.append(np.full(len(texts), label))
    model = conditional(of(1, -1), of(0, -1), window)
    model.slope, model.middle = _curve(np.concatenate(x), np.concatenate(y))
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    window: int = WINDOW,
) -> Model:
    """The model of at most ``sample`` labelled texts of each class."""
    label = s.column(label_col)
    known = (
        labels.where(label.isin(0, 1)).groupBy(s.column(id_col).alias("id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").select("id", "label")
    )
    # Ids first: the texts of at most 2 x sample of them are moved.
    ids = known.join(docs.select(s.column(id_col).alias("id")), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    picked = [ids.where(F.col("label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = s.materialize(picked[0].unionByName(picked[1]), "picked")
    texts = (
        docs.select(s.column(id_col).alias("id"), s.column(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "label").agg(F.max("text").alias("text"))
        .select("label", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), "text")
    )
    names = ["runs", "ratio", "histories", "left"]

    def run(batches):
        parts: list[tuple[int, int, pa.Array]] = []
        for whole in batches:
            for batch in s.chunks([whole], "text"):
                label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
                for y, f in set(zip(label.tolist(), fold.tolist(), strict=True)):
                    parts.append((y, f, batch.column("text").filter(pa.array((label == y) & (fold == f)))))
        if {y for y, _, _ in parts} == {0, 1}:
            model = fitted(parts, window)
            made = [pa.array([getattr(model, n).tobytes()], pa.binary()) for n in names]
            yield pa.RecordBatch.from_arrays([*made, pa.array([model.slope]), pa.array([model.middle])], [*names, "slope", "middle"])

    schema = "runs binary, ratio binary, histories binary, left binary, slope double, middle double"
    row = texts.coalesce(1).mapInArrow(run, schema).first()
    if row is None:
        none = np.zeros(0)
        return Model(none.astype(np.uint64), none, none.astype(np.uint64), none, window=window)
    kinds = [np.uint64, np.float64] * 2
    arrays = [np.frombuffer(row[n], kind) for n, kind in zip(names, kinds, strict=True)]
    return Model(*arrays, row.slope, row.middle, window)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", extra: tuple[Column, ...] = ()) -> DataFrame:
    """id, the ``extra`` columns, score (0 to 1, higher is more toxic) and predicted of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(s.column(id_col).alias("id"), *extra, s.column(text_col).alias("text"))
    schema = narrow.drop("text").schema.add("score", "double").add("predicted", "integer")
    names = [f.name for f in schema.fields[:-2]]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = shipped.value.scores(batch.column("text"))
        kept = [batch.column(n) for n in names]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(points), pa.array((points >= 0.5).astype(np.int32))], [*names, "score", "predicted"]
        )

    return s.map_chunks(narrow, "text", run, schema)
