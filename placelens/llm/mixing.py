"""Mixing sources to target weights by weighted fair queueing, as DataFrame expressions only.

Sources take turns as queues do in weighted fair queueing. A source's documents are shuffled by a
hash of their id. An item's virtual finish time is the number of words its source has up to and with
it, divided by the source's weight; a source may be gone through up to ``epochs`` times. Items of all
sources are range-sorted by that time and cut where the total budget is used up. A source
that has run out leaves its share to the others by weight, which is what the targets say.

The cut is one virtual time for all sources. It is found from the sources' sizes: sorted by the time
at which each runs out, the budget less what the finished ones hold, divided by the weights of the
others. An item across the cut is taken if at least half of it lies before.

Running sums are split: a source's documents fall into ranges of the shuffle order, ranges get their offset
from sums of the ranges before, and only one range is summed at a time. So a source with most of
the rows is spread as evenly as any.

Edge cases: a null text has size 0; a null source is a source of its own, last in order; documents
without words take no part and nothing is taken of them; repeated rows are documents of their own, in an order
that doesn't change the result; an empty table gives no rows; other columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelens.llm.shared import column, free_name, materialize

WEIGHTS = (5, 2, 1)
EPOCHS = 3
ROWS_IN_RANGE = 2048
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(id_text: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, weight, source_size, target of a table with source and size; the budget is the sum of sizes.

    One row per source is sorted in one task: sources are a catalogue, far fewer than documents.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Code point order is the order of the UTF-8 bytes, which is how Spark compares strings.
    ranked = by_source.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights) + 1))
    # a / w1 <= b / w2 as integers would need products; ties in the quotient are all right.
    ends = Window.orderBy(F.col("source_size") * epochs / F.col("weight"), "rank")
    before = ends.rowsBetween(Window.unboundedPreceding, -1)
    rest = ends.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = (
        ranked.withColumn("budget", F.sum("source_size").over(whole))
        .withColumn("held", F.coalesce(F.sum(F.col("source_size") * epochs).over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(rest))
        .withColumn("level", (F.col("budget") - F.col("held")) / F.col("open"))
    )
    # While finished sources are put aside the level rises, with any that isn't finished it falls.
    cut = F.coalesce(F.max("level").over(whole), F.lit(0.0))
    return levels.withColumn("cut", cut).select(
        "source",
        "weight",
        "source_size",
        F.least((F.col("source_size") * epochs).cast("double"), F.col("weight") * F.col("cut")).alias("target"),
        "cut",
    )


def schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: int = 7,
) -> DataFrame:
    """For every document: its id, source, size, source_size, target and ``finish``.

    finish: the virtual finish times of those of its items that the mix takes, one per repeat.
    """
    rows = docs.select(
        column(id_col).alias("id"), column(source_col).alias("source"), n_words(column(text_col)).alias("size")
    )
    rows = materialize(rows.withColumn("order", shuffle_key(F.col("id").cast("string"), seed)), "sizes")
    return _scheduled(rows, weights, epochs).withColumnRenamed("id", id_col).withColumnRenamed("source", source_col)


def _scheduled(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    ranges = max(1, rows.count() // ROWS_IN_RANGE)
    rows = rows.withColumn(
        "range", F.expr(f"cast(conv(substr(`order`, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296")
    )
    targets = materialize(source_targets(rows, weights, epochs), "targets")
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0))).withColumn(
        "key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    )
    keyed = targets.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    offsets = materialize(offsets.join(keyed, "key").select("key", "range", "offset", *keyed.drop("key").columns), "offsets")
    placed = rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).join(offsets, ["key", "range"])
    inside = Window.partitionBy("key", "range").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, 0)
    done = placed.withColumn("upto", F.col("offset") + F.sum("size").over(inside))
    items = F.transform(
        F.sequence(F.lit(0), F.lit(epochs - 1)), lambda e: F.col("upto") + F.col("source_size") * e
    )
    taken = F.filter(items, lambda x: (F.col("size") > 0) & (x - F.col("size") / 2 <= F.col("target")))
    return done.select(
        "id", "source", "size", "source_size", "target",
        F.transform(taken, lambda x: x / F.col("weight")).alias("finish"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix: a row of ``docs`` for every time it is taken, range-sorted by virtual finish time.

    Columns are those of ``docs``, then size, source_size, target, repeat (from 0) and finish, with underscores
    behind a name that is taken. Rows that are equal in id, source and text share their repeats evenly.
    """
    tag = free_name(docs, "_row")
    copy = free_name(docs, "_copy")
    tagged = docs.withColumn(
        tag, F.xxhash64(column(id_col), column(text_col), column(source_col))
    )
    keys = tagged.select(
        F.col(tag).alias("id"), column(id_col).alias("own"), column(source_col).alias("source"), n_words(column(text_col)).alias("size")
    )
    seed, weights, epochs = options.get("seed", 7), options.get("weights", WEIGHTS), options.get("epochs", EPOCHS)
    rows = materialize(
        keys.select("id", "source", "size", shuffle_key(F.col("own").cast("string"), seed).alias("order")), "sizes"
    )
    plan = _scheduled(rows, weights, epochs).where(F.size("finish") > 0)
    names = {n: free_name(docs, n) for n in ("size", "source_size", "target", "repeat", "finish")}
    on = [tag]
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        # Rows that are the same in id, text and source are numbered on both sides, within their key.
        plan = plan.withColumn(copy, F.row_number().over(Window.partitionBy("id").orderBy("finish")))
        tagged = tagged.withColumn(copy, F.row_number().over(Window.partitionBy(tag).orderBy(tag)))
        on.append(copy)
    plan = plan.select(
        F.col("id").alias(tag), *on[1:], *[F.col(n).alias(names[n]) for n in ("size", "source_size", "target")],
        F.posexplode("finish").alias(names["repeat"], names["finish"]),
    )
    joined = tagged.join(plan, on).drop(*on)
    return joined.orderBy(names["finish"], column(source_col), column(id_col), names["repeat"])
