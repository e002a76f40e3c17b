"""Exact top-k inner products by KD-trees per shard.

Vectors are dealt into shards by a hash of their id, a bounded number each. A shard builds a KD-tree: median
splits on the widest dimension down to leaves, each with a tight bounding box and its least id. Queries
come in bounded blocks. A block meets a shard's tree best-first: the largest inner product that a box allows is
the sum of q * high where q is positive and q * low elsewhere; boxes are opened from the highest bound
down until it is below the kth score. First a block meets one shard alone; the kth scores found
there go on to all other shards, which return only what can enter the result. A bound equal to the
kth score is opened only if the box may hold a smaller id.

Blocks of queries and shards are equi-joined by shard number; trees and blocks are a row each, bounded by their size
parameters. Results of a query are merged by rank.

Edge cases: vectors that are null, empty or have a null or non-finite component take no part; vectors of different
length never meet; rows with the query's id are its own and never candidates of it; repeated
rows count once; fewer candidates give fewer rows; scores beyond 64 bits aren't supported.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placelens.llm import shared as s

SHARD = 8192
BLOCK = 512
LEAF = 128


class Tree:
    """A KD-tree over integer vectors, as arrays of its leaves and inner boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order, self.first, self.last, self.kids = np.arange(len(ids)), [], [], []
        stack = [(0, len(ids), None)]
        while stack:
            start, stop, parent = stack.pop()
            node = len(self.first)
            self.first.append(start)
            self.last.append(stop)
            self.kids.append([])
            if parent is not None:
                self.kids[parent].append(node)
            own = vectors[order[start:stop]]
            if stop - start > leaf:
                axis = int((own.max(0) - own.min(0)).argmax())
                half = (stop - start) // 2
                order[start:stop] = order[start:stop][np.argpartition(own[:, axis], half)]
                stack += [(start, start + half, node), (start + half, stop, node)]
        self.ids, self.vectors = ids[order], vectors[order]
        spans = list(zip(self.first, self.last, strict=True))
        self.low = np.array([self.vectors[a:b].min(0) for a, b in spans])
        self.high = np.array([self.vectors[a:b].max(0) for a, b in spans])
        self.least = np.array([self.ids[a:b].min() for a, b in spans])

    def search(self, query_ids, queries, k, floor):
        """For each query the scores and ids of its best k; floor: (score, id) that a result must reach."""
        for q, own, (least, limit_id) in zip(queries, query_ids, floor, strict=True):
            positive, negative = np.maximum(q, 0), np.minimum(q, 0)
            bound = self.high @ positive + self.low @ negative
            best_s, best_i = np.zeros(0, bound.dtype), np.zeros(0, np.int64)
            heap = [(-bound[0], 0)]
            while heap:
                top, node = heapq.heappop(heap)
                if -top < least:
                    break
                if -top == least and limit_id is not None and self.least[node] > limit_id:
                    continue
                if self.kids[node]:
                    for kid in self.kids[node]:
                        if bound[kid] >= least:
                            heapq.heappush(heap, (-bound[kid], kid))
                    continue
                a, b = self.first[node], self.last[node]
                scores, ids = self.vectors[a:b] @ q, self.ids[a:b]
                good = (scores >= least) & (ids != own)
                if not good.any():
                    continue
                best_s, best_i = np.r_[best_s, scores[good]], np.r_[best_i, ids[good]]
                rank = np.lexsort((best_i, -best_s))[:k]
                best_s, best_i = best_s[rank], best_i[rank]
                if len(rank) == k and (limit_id is None or (best_s[-1], -best_i[-1]) > (least, -limit_id)):
                    least, limit_id = best_s[-1], best_i[-1]
            yield best_s, best_i


def _numbers(vectors: pa.Array) -> np.ndarray:
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.int64)
    matrix = values.reshape(len(vectors), -1)
    most = int(np.abs(matrix).max()) if matrix.size else 0
    # Doubles hold these products and sums exactly, and multiply faster.
    return matrix.astype(np.float64) if most * most * max(1, matrix.shape[1]) < 2**52 else matrix


def _packed(table: DataFrame, group: list[str], build) -> DataFrame:
    """One row for each group, with ``build(ids, vectors)`` pickled."""

    def run(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        ids = part.column("id").to_numpy().astype(np.int64)
        made = pickle.dumps(build(ids, _numbers(part.column("vector").combine_chunks())), protocol=5)
        arrays = [pa.array([k.as_py()], pa.int32()) for k in key]
        return pa.Table.from_arrays([*arrays, pa.array([made], pa.binary())], [*group, "made"])

    return table.groupBy(*group).applyInArrow(run, ", ".join(f"{g} int" for g in group) + ", made binary")


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. Both tables have the columns id (long) and vector (array of long).

    Rows without an id can't be told apart and take no part; an empty table gives no rows.
    """
    usable = lambda t: t.where("id is not null").select("id", "vector", F.size("vector").alias("dim")).distinct()
    vectors, queries = s.materialize(usable(vectors), "vectors"), s.materialize(usable(queries), "queries")
    shards = max(1, -(-vectors.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    trees = s.materialize(
        _packed(vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")), ["dim", "shard"], Tree), "trees"
    )
    asked = s.materialize(
        _packed(
            queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), ["dim", "block"], lambda i, v: (i, v)
        ),
        "blocks",
    )
    home = F.pmod(F.col("block"), F.lit(shards))

    def first(batches):
        yield from _run(batches, k, lambda row: None)

    def others(batches):
        yield from _run(batches, k, lambda row: pickle.loads(row["floor"]))

    out = "dim int, block int, query_id long, vec_id long, score long"
    tree = trees.withColumnRenamed("made", "tree")
    begun = s.materialize(asked.withColumn("shard", home).join(tree, ["dim", "shard"]).mapInArrow(first, out), "begun")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        begun.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") == k)
        .groupBy("dim", "block")
        .applyInArrow(_floors, "dim int, block int, floor binary")
    )
    rest = asked.join(kth, ["dim", "block"], "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    ).where(F.col("shard") != home)
    more = rest.repartition("shard", "block").join(tree, ["dim", "shard"]).mapInArrow(others, out)
    return (
        begun.unionByName(more)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _floors(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
    ids, scores, kth = (part.column(c).to_pylist() for c in ("query_id", "score", "vec_id"))
    floor = pickle.dumps(dict(zip(ids, zip(scores, kth, strict=True), strict=True)), protocol=5)
    return pa.Table.from_arrays(
        [*[pa.array([x.as_py()], pa.int32()) for x in key], pa.array([floor], pa.binary())], ["dim", "block", "floor"]
    )


def _run(batches, k, floors):
    for batch in batches:
        for row in batch.to_pylist():
            known = (floors(row) if row.get("floor") is not None else None) or {}
            tree, (ids, vectors) = pickle.loads(row["tree"]), pickle.loads(row["made"])
            floor = [known.get(int(i), (-np.inf, None)) for i in ids]
            found = list(tree.search(ids, vectors.astype(tree.vectors.dtype), k, floor))
            sizes = [len(x) for x, _ in found]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(sum(sizes), row["dim"], np.int32)),
                        pa.array(np.full(sum(sizes), row["block"], np.int32)),
                        pa.array(np.repeat(ids, sizes)),
                        pa.array(np.concatenate([i for _, i in found])),
                        pa.array(np.concatenate([x for x, _ in found]).astype(np.int64)),
                    ],
                    ["dim", "block", "query_id", "vec_id", "score"],
                )
