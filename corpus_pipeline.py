"""A training-corpus pipeline: five corpus operators in a row over the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes what a stage returns as
Parquet in the shared folder, reads it again for the next and deletes what it read before. Files are read in any
order, so ``run`` returns the mix sorted as it was written, by ``finish``.

Edge cases: a null text is an empty one and stays a null; documents without words are judged by the classifier's bias, have
no near duplicates, spans or leaks, and the mix takes nothing of them; rows without an id are documents of their own; of rows equal in id
and text one stays; equal finish times are in order of source and id; an empty table gives an empty one; very long texts
are read whole; other columns are kept, and the mix's own get an underscore behind a name that is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.llm import decontaminate, jaccard, mixing, quality, spans
from placelens.llm.shared import Scope, column, free_name, materialize, release

#: No stage before the last adds or drops columns; the classifier is learned, hence no SQL.
ORACLE_SQL = None


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels of ``docs``, finds good."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links of 0.8 over five words hold together: with the smallest id, null last.

    Rows are told apart by id and text; of rows that are equal in both one stays, as of any copies.
    """
    own, copies, of_id, of_text = (free_name(docs, n) for n in ("_text_hash", "_copies", "_kept_id", "_kept_hash"))
    hashed = docs.withColumn(own, F.xxhash64("text"))
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(own).alias("hash"))
    with Scope() as scope:
        groups = jaccard.jaccard_groups(hashed.select(row.alias("row"), "text"), id_col="row")
        kept = groups.where("row <=> component_id").groupBy("row.id", "row.hash").agg(F.count("*").alias(copies))
        kept = scope.keep(materialize(kept.withColumnsRenamed({"id": of_id, "hash": of_text}), "kept"))
    there = docs.columns
    found = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_text)))
    if kept.where(column(copies) > 1).isEmpty():
        return found.select(*map(column, there))
    once = found.where(column(copies) == 1)
    again = found.where(column(copies) > 1).dropDuplicates(["doc_id", own])
    return once.unionByName(again).select(*map(column, there))


def _repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated spans of sentences; a document that loses all it has goes."""
    removed = free_name(docs, "_removed")
    cut = spans.drop_repeated_spans(docs, removed_col=removed)
    return cut.where((column(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop(removed)


def _decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, each as often as the mix takes it."""
    return mixing.mix(docs)


STAGES = [
    ("quality", _quality),
    ("near_duplicates", _near_duplicates),
    ("repeated_spans", _repeated_spans),
    ("decontamination", _decontaminated),
    ("mixing", _mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, in the order of the mix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    finish = free_name(docs, "finish")
    for name, stage in STAGES:
        with Scope() as scope:
            made = materialize(stage(spark, docs, sf_dir), name)
            scope.keep(made)
        release(docs)
        docs = made
    return docs.orderBy(finish, "source", "doc_id", docs.columns[docs.columns.index(finish) - 1])
