"""How a large table meets a dimension.

A dimension is broadcast only when its size is known to be small. Beyond the bound
the join shuffles, with the fact side salted so that one hot key is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def free_names(wanted: list[str], *tables: DataFrame) -> list[str]:
    """The wanted names, with underscores behind those that a table already has in any case."""
    taken = {c.lower() for df in tables for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: from file sizes, no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def planner_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").lower()
    digits = text.rstrip("kmgb")
    unit = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(digits) * unit[text[len(digits):].rstrip("b") or ""]


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows written out as text: one aggregate job over the dimension."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def is_small(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a dimension may be broadcast: by the estimate if that suffices, else measured."""
    return estimated_bytes(dimension) <= planner_limit(dimension) or measured_bytes(dimension) <= limit


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    how: str = "inner",
    small: bool | None = None,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table with a dimension, without shuffling the large one if possible.

    * the optimizer already knows the dimension is small: a plain join, which it broadcasts;
    * its estimate is only a loose bound (an aggregate over a big table): the dimension is
      measured, and broadcast if it is within ``limit``;
    * otherwise a salted shuffle join.

    ``small`` is the verdict of :func:`is_small` where the caller has it already, on this
    dimension or on one that it cannot outgrow; then nothing is checked here.
    """
    if small is None and estimated_bytes(dimension) <= planner_limit(dimension):
        return facts.join(dimension, on, how)
    if small or (small is None and measured_bytes(dimension) <= limit):
        return facts.join(F.broadcast(dimension), on, how)
    return salted_join(facts, dimension, on, how, salts)


def salted_join(
    facts: DataFrame, dimension: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join that spreads each key of ``facts`` over ``salts`` tasks.

    Every fact row gets one salt, every dimension row all of them, so each pair of
    rows still meets exactly once. The salt is a hash of the row, so a recomputed task
    gives the same one; exact copies of a row share it, and a partition they fill is
    split by adaptive execution. ``how`` may be inner, left or left_semi.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salting does not preserve a {how!r} join")
    flat = [c for c, t in facts.dtypes if not t.startswith(("map", "variant"))]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in flat]), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    (name,) = free_names(["_salt"], facts, dimension)
    return (
        facts.withColumn(name, salt)
        .join(dimension.withColumn(name, copies), [*on, name], how)
        .drop(name)
    )
