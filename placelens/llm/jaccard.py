"""Exact Jaccard self-join of word shingles: groups of documents that links hold together.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of word shingles.
The result is a class and a component for each document, not all pairs.

1. Documents with the same set become one class, so exact copies cost nothing further.
2. A first prefix filter, in the order of the shingles' hashes: two linked sets of about n shingles
   share at least k(n) of the first ``n - required + k(n)``, where k grows with n. A class without
   so many prefix shingles that another class has as well links with nothing. That needs counts
   of about a fifth of all shingles, and few unrelated documents remain.
3. What remains is ordered by true frequency, rarest first, and the prefix extended by one, so that
   linked sets share at least two prefix shingles. A shingle of a rare class is a key alone;
   those of the frequent class are keys in combinations of two. A pair that shares a
   single key is found by it, any other pair shares two frequent ones, hence a combination.
4. Within a key every class is first verified against one hub, the class with the fewest shingles
   of its own, which in a group of near copies is the least edited one. That ties a group
   together with one comparison a member. Then come all pairs of a key that still are in different
   components. A pair is made at its first common key, the rarest: all shingles that either class
   has before it aren't shared, and if they and the sizes exclude a link the pair isn't made. Shingles of the
   frequent class only count those of the rare one as before them.
5. Every link is verified on the whole sets. Components spread by least label with pointer jumps.

Nothing is capped. Hot shingles are counted with partial aggregation; joins on them have plain
shuffles on both sides, which adaptive execution splits.

Edge cases: a null, empty or blank text has an empty set and links with nothing; repeated rows and
rows that share an id are each judged by their text; a null id never names a component unless all
ids of it are null; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.llm import shared as s

FREQUENT = 256
HUB_SHARE = 8
MOST_IN_COMBINATIONS = 32
FILTER_SEGMENTS = 512


def _required(n, percent: int):
    """The least intersection of a set of n with any set it links to."""
    return -(-n * percent // 100)


def _shared_at_least(n, percent: int):
    return np.minimum(_required(n, percent), 4 + n // 20)


def _sets(words: s.Words, k: int):
    """(text, hash) of the distinct shingles in order of text and hash, and (count, class) of each text."""
    text, hashes = words.shingles(k)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    if len(text):
        new = np.r_[True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])]
        text, hashes = text[new], hashes[new]
    n = np.bincount(text, minlength=words.texts)
    total = np.r_[np.uint64(0), np.cumsum(s.mix(hashes ^ np.uint64(0xA5A5A5A5)))]
    end = np.cumsum(n)
    label = s.mix((total[end] - total[end - n]) ^ n.astype(np.uint64))
    return text, hashes, n, label


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """id, class ``c`` (null for an empty set), set size ``n`` and the first prefix of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, hashes, n, label = _sets(s.Words(batch.column("text")), k)
        place = np.arange(len(text)) - (np.cumsum(n) - n)[text]
        longest = n - _required(n, percent) + _shared_at_least(n, percent)
        kept = place < longest[text]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(s.signed(label), mask=n == 0),
                pa.array(n.astype(np.int32)),
                s.lists(s.signed(hashes[kept]), np.bincount(text[kept], minlength=len(n))),
            ],
            ["id", "c", "n", "prefix"],
        )

    narrow = docs.select(s.column(id_col).alias("id"), s.column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return s.map_chunks(narrow, "text", run, f"id {kind}, c long, n int, prefix array<long>")


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Classes whose first prefix allows a link."""
    exploded = classes.select("c", F.explode("prefix").alias("token"))
    repeated = s.materialize(
        exploded.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token"), "repeated"
    )
    least = f"-((-n * {percent}) div 100)"
    least_k = f"least(-((-({least}) * {percent}) div 100), 4 + ({least}) div 20)"
    met = exploded.join(repeated, "token").groupBy("c").agg(F.count("*").alias("met"))
    return classes.select("c", "n", "rep").join(met, "c").where(f"n > 1 and met >= {least_k}").select("c", "n", "rep")


def _whole_sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """c, n and all shingles of the chosen classes, from one document of each.

    A Bloom filter of at most 64 MiB keeps most other documents from being shuffled; what
    it lets pass is removed by a join, so its size never changes the result.
    """
    key = F.xxhash64("rep", "c")
    count = chosen.count()
    bits = s.build_bloom(
        chosen.select(key.alias("key"), F.lit(0).alias("salt")), min(FILTER_SEGMENTS, s.segments_for(count))
    )
    shipped = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        text, hashes, n, label = _sets(s.Words(batch.column("text")), k)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(s.signed(label)), s.lists(s.signed(hashes), n)], ["id", "c", "tokens"]
        )

    def screen(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            rows = np.flatnonzero(s.bloom_probe(shipped.value, keys))
            if len(rows):
                yield batch.take(pa.array(rows)).select(["c", "tokens", "id"])

    narrow = docs.select(s.column(id_col).alias("id"), s.column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    sets = s.map_chunks(narrow, "text", run, f"id {kind}, c long, tokens array<long>")
    keyed = sets.select("id", "c", F.xxhash64("id", "c").alias("key"), "tokens")
    screened = keyed.mapInArrow(screen, f"c long, tokens array<long>, id {kind}")
    picked = screened.join(chosen.withColumnRenamed("c", "d"), F.expr("c = d and id <=> rep"))
    return picked.select("c", "n", "tokens").dropDuplicates(["c"])


def _keys(sets: DataFrame, percent: int) -> DataFrame:
    """key, class, size, ``lone`` shingles that no other class has and ``own`` ones before the key, for the second prefix."""
    exploded = sets.select("c", "n", F.explode("tokens").alias("token"))
    counted = s.materialize(exploded.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "counted")
    length = f"n - (-((-n * {percent}) div 100)) + 2"
    prefixes = (
        exploded.join(counted, "token")
        .groupBy("c", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("met"))
        .withColumn("own", F.expr("n - size(met)"))
        .where(f"100 * (n - own) >= {percent} * n and own < {length}")
        .withColumn("low", F.expr(f"own + size(filter(met, m -> m.df <= {FREQUENT}))"))
        .select("c", "n", "own", "low", F.expr(f"slice(met, 1, {length} - own)").alias("met"))
    )
    prefixes = s.materialize(
        prefixes.withColumn("frequent", F.expr(f"size(filter(met, m -> m.df > {FREQUENT}))")), "prefixes"
    )
    tokens = prefixes.select("c", "n", "own", "low", "frequent", F.posexplode("met").alias("pos", "m")).select(
        "c", "n", F.col("own").alias("lone"), F.expr("least(own + pos, low)").alias("own"), "frequent", "m.*"
    )
    combined = s.materialize(
        tokens.where(f"df > {FREQUENT}")
        .groupBy("token")
        .agg(F.max("frequent").alias("most"))
        .where(f"most <= {MOST_IN_COMBINATIONS}")
        .select("token"),
        "combined",
    )
    rare = tokens.where(f"df <= {FREQUENT}")
    frequent = tokens.where(f"df > {FREQUENT}").join(combined.withColumn("hit", F.lit(True)), "token", "left")
    columns = ["token", "c", "n", "lone", "own"]
    alone = rare.select(columns).unionByName(frequent.where("hit is null").select(columns))
    pairs = (
        frequent.where("hit")
        .groupBy("c", "n", "lone", "own")
        .agg(F.sort_array(F.collect_list("token")).alias("t"))
        .select(
            F.explode(
                F.expr("flatten(transform(t, (x, i) -> transform(slice(t, i + 2, size(t)), y -> xxhash64(x, y))))")
            ).alias("token"),
            "c",
            "n",
            "lone",
            "own",
        )
    )
    alone, pairs = (x.withColumn("combined", F.lit(y)) for x, y in ((alone, False), (pairs, True)))
    return alone.unionByName(pairs).withColumnRenamed("token", "key")


def _may_link(percent: int) -> Column:
    """A bound from sizes and own shingles of classes a and b: those are in the union, never shared."""
    return F.expr(
        f"""100 * least(na - oa, nb - ob) >= {percent} * greatest(na + ob, nb + oa)"""
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes that link, by their whole sets."""
    left = sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
    met = (
        pairs.select("a", "b")
        .join(right, "b")
        .join(left, "a")
        .select("a", "b", F.expr("size(ta) + size(tb)").alias("both"), F.expr("size(array_intersect(ta, tb))").alias("met"))
    )
    return met.where(f"100 * met >= {percent} * (both - met)").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """v and its component, the least v that links (a, b) reach from it."""
    both = s.materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    state = table = s.materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("comp")), "state")
    while True:
        near = both.join(state, F.col("b") == F.col("v")).groupBy("a").agg(F.min("comp").alias("near"))
        step = state.join(near, F.col("v") == F.col("a")).select(
            "v", F.col("comp").alias("old"), F.least("comp", "near").alias("mid")
        )
        jump = state.select(F.col("v").alias("mid"), F.col("comp").alias("far"))
        new = s.materialize(
            step.join(jump, "mid").select("v", "old", F.least("mid", "far").alias("comp")), "state"
        )
        changed = not new.where("comp <> old").isEmpty()
        s.release(table)
        state, table = new.select("v", "comp"), new
        if not changed:
            s.release(both)
            return state


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """For every row: id, ``n_shingles``, ``n_copies`` with the same set, ``component_id``.

    The component is named by its smallest id. k: words in a shingle; percent: the similarity.
    """
    with s.Scope() as scope:
        return scope.keep(s.materialize(_grouped(docs, id_col, text_col, k, percent), "groups"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    with_prefix = s.materialize(shingle_sets(docs, id_col, text_col, k, percent), "sets")
    first_prefix = s.materialize(
        with_prefix.where("c is not null").groupBy("c").agg(
            F.first("n").alias("n"), F.min("id").alias("rep"), F.count("*").alias("n_copies"), F.first("prefix").alias("prefix")
        ),
        "classes",
    )
    chosen = s.materialize_alone(lambda: _candidates(first_prefix, percent), "chosen")
    # From here on without prefixes.
    rows = s.materialize(with_prefix.select("id", "c", "n"), "sets")
    classes = s.materialize(first_prefix.select("c", "rep", "n_copies"), "classes")
    s.release(with_prefix, first_prefix)
    sets = s.materialize(_whole_sets(docs, chosen, id_col, text_col, k), "whole")
    keys = s.materialize_alone(lambda: _keys(sets, percent), "keys")
    hubs = s.materialize(
        keys.groupBy("key")
        .agg(F.count("*").alias("size"), F.min(F.struct("lone", "c", "n", "own")).alias("hub"))
        .where("size > 1")
        .select("key", F.col("hub.c").alias("a"), F.col("hub.n").alias("na"), F.col("hub.own").alias("oa")),
        "hubs",
    )
    # Hubs only tie groups together, so an eighth of the many combinations will do; the rest below is exact.
    proposed = keys.where(f"not combined or pmod(key, {HUB_SHARE}) = 0")
    member = proposed.select("key", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("own").alias("ob"))
    stars = member.join(hubs, "key").where(F.col("a") != F.col("b")).where(_may_link(percent)).select("a", "b").distinct()
    first = s.materialize(_verified(stars, sets, percent), "first")
    tied = components(first)
    # What is left: keys whose classes are in several components.
    held = keys.join(tied.withColumnRenamed("v", "c"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    held = s.materialize(held.join(hubs.select("key", F.col("a").alias("hub")), "key"), "held")
    s.release(keys, hubs)
    open_keys = s.materialize(
        held.groupBy("key")
        .agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max(F.when(F.col("c") == F.col("hub"), F.col("comp"))).alias("main"))
        .where("x <> y")
        .select("key", "main"),
        "open",
    )
    a = held.select("key", F.col("c").alias("a"), F.col("n").alias("na"), F.col("own").alias("oa"), F.col("comp").alias("ca"))
    b = held.select("key", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("own").alias("ob"), F.col("comp").alias("cb"))
    outside = s.materialize(a.join(open_keys, "key").where("ca <> main"), "outside")
    across = (
        outside.join(b, "key")
        .where("ca <> cb and (cb = main or a < b)")
        .where(_may_link(percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    second = _verified(across, sets, percent)
    tied = components(first.unionByName(second))
    named = classes.select("c", "n_copies", "rep").join(tied.withColumnRenamed("v", "c"), "c", "left")
    named = named.withColumn("comp", F.coalesce("comp", "c"))
    names = named.groupBy("comp").agg(F.min("rep").alias("component_id"), F.count("*").alias("n_classes"))
    named = s.materialize(named.join(names, "comp").select("c", "n_copies", "n_classes", "component_id"), "named")
    return rows.join(named, "c", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
