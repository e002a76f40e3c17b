"""Conversation repair: the cheapest edits to a legal order of roles, by bidirectional Dijkstra over the edit lattice.

A legal conversation has role initials ``(s?(ua)+)?``. A row's first fault counts: blank (no sign that isn't white space),
duplicate (role and text seen earlier in the conversation), truncated (the last sign that isn't white space is no full
stop, question or exclamation mark). Edits: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of a user or
assistant row with an empty text 3. Blank and duplicate rows must go; a truncated row that stays adds 3.

A node of the lattice is (rows read, where in the grammar): start, after s, after u, after a. A forward heap from the
start and a reverse heap from the legal ends are settled in turn, the cheaper one first, until their least costs
together exceed the cheapest meeting; all edges that leave the forward side at that cost are then equal-cost crossings, and the one
with the least concatenated audit (initials of the edits in order) wins. Of equal costs at a node the least audit is kept: no
cheapest audit to a node is the beginning of another one there, as that would take inserts that lead back to the node. An audit is a
chain of edits that shares what it has in common with others, so a conversation takes memory in proportion to its rows.

Faults and order are DataFrame expressions: a copy is told by a window over conversation, role and text. The
rows of a conversation meet in one value, as the repaired conversation does; so a conversation must be under 2 GB. Nothing else meets.

Edge cases: null roles and texts count as one space, and so do null ids and turns where they are hashed; rows without a turn come
first, equal turns in order of role and text; a role with no initial, or with another one than s, u and a, is reroled or
deleted; repeated rows are duplicates; a null id is a conversation; texts of any length pass through Python unread; an empty table
gives no rows; other columns don't matter.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placelens.llm.shared import column

SIGN = r"[^\x20\x09-\x0D]"
FINISHED = r"[.!?][\x20\x09-\x0D]*\z"
LEGAL = ["su", "ua", "au"]
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Where each initial leads from start (0), s (1), u (2) and a (3); only start and a are legal ends.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS = (0, 3)
BACK = {x: {to: [at for at, y in moves.items() if y == to] for to in moves.values()} for x, moves in STEPS.items()}


# Damage.


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role and text after a repeatable damage of every row, by a hash of conversation and turn, and ``dropped``.

    Of twenty values 0 drops the row, 1 empties its text, 2 removes stops, 3 repeats the row, 4 makes it the user's.
    """
    shown = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    key = F.concat(shown(conv_col), F.lit(":"), shown(turn_col))
    rows = turns.select(
        column(conv_col).alias("conv_id"),
        column(turn_col).alias("turn"),
        shown(role_col).alias("role"),
        shown(text_col).alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("harm"),
    )
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (harm == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(1), F.when(harm == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


# Edits.


def _forward(at: tuple[int, int], rows: tuple[tuple[str, int], ...]):
    """(cost, edit, next node) of every edit that leads on from a node; rows: initial and fault (0 none, 1 must go, 2 truncated)."""
    i, state = at
    for x in ROLES:
        if state in STEPS[x]:
            yield INSERT, "I", (i, STEPS[x][state])
    if i < len(rows):
        initial, fault = rows[i]
        yield DELETE, "D", (i + 1, state)
        if fault != 1:
            more = TRUNCATED if fault == 2 else 0
            if state in STEPS.get(initial, ()):
                yield KEEP + more, "K", (i + 1, STEPS[initial][state])
            for x in ROLES:
                if x != initial and state in STEPS[x]:
                    yield REROLE + more, "R", (i + 1, STEPS[x][state])


def _reverse(at: tuple[int, int], rows: tuple[tuple[str, int], ...]):
    """(cost, edit, node before) of every edit that leads to a node."""
    i, state = at
    for x in ROLES:
        for before in BACK[x].get(state, ()):
            yield INSERT, "I", (i, before)
    if i:
        initial, fault = rows[i - 1]
        yield DELETE, "D", (i - 1, state)
        if fault != 1:
            more = TRUNCATED if fault == 2 else 0
            for before in BACK.get(initial, {}).get(state, ()):
                yield KEEP + more, "K", (i - 1, before)
            for x in ROLES:
                if x != initial:
                    for before in BACK[x].get(state, ()):
                        yield REROLE + more, "R", (i - 1, before)


# Audits are chains (edit, rest): of the forward side from the last edit on, of the reverse side from the first.


def _unrolled(chain: tuple | None) -> list[str]:
    out = []
    while chain is not None:
        out.append(chain[0])
        chain = chain[1]
    return out


def _reverse_less(a: tuple | None, b: tuple | None) -> bool:
    while a is not b:
        if a is None or b is None:
            return b is not None
        if a[0] != b[0]:
            return a[0] < b[0]
        a, b = a[1], b[1]
    return False


def _forward_less(a: tuple | None, b: tuple | None) -> bool:
    """Which audit is less where both are told from their ends: what lies before a shared rest doesn't matter."""
    x, y = [], []
    while a is not b:
        # The longer one, by its depth, is told first.
        if b is None or (a is not None and a[2] >= b[2]):
            x.append(a[0])
            a = a[1]
        else:
            y.append(b[0])
            b = b[1]
    return x[::-1] < y[::-1]


class _Side:
    """One heap, with the costs and least audits of the nodes it has met."""

    def __init__(self, starts: list[tuple[int, int]], forward: bool, rows: tuple[tuple[str, int], ...]):
        self.rows, self.sign = rows, 1 if forward else -1
        self.edits, self.less = (_forward, _forward_less) if forward else (_reverse, _reverse_less)
        self.cost: dict = {x: 0 for x in starts}
        self.audit: dict = {x: None for x in starts}
        self.settled: set = set()
        # Of equal costs the node with fewer rows read from this side comes first: edits at no cost read a row.
        self.heap = [(0, self.sign * x[0], x[1]) for x in starts]
        heapq.heapify(self.heap)

    def least(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[tuple[int, int], list]:
        """The cheapest node that isn't settled yet, with the nodes its edits lead to."""
        self.least()
        cost, i, state = heapq.heappop(self.heap)
        node = (self.sign * i, state)
        self.settled.add(node)
        chain, met = self.audit[node], []
        depth = chain[2] + 1 if chain else 1
        for more, edit, to in self.edits(node, self.rows):
            met.append((cost + more, to))
            if to in self.settled:
                continue
            total, before = cost + more, self.cost.get(to)
            label = (edit, chain, depth)
            if before is None or total < before or total == before and self.less(label, self.audit[to]):
                self.cost[to], self.audit[to] = total, label
                if before is None or total < before:
                    heapq.heappush(self.heap, (total, self.sign * to[0], to[1]))
        return node, met


def cheapest(rows: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits; of equal costs the least audit. rows: initial and fault of each row."""
    if not rows:
        return 0, ""
    ends = [(len(rows), x) for x in ENDS]
    forward, reverse = _Side([(0, 0)], True, rows), _Side(ends, False, rows)
    forward.settle()
    best = float("inf")
    for _ in ends:
        reverse.settle()
    for node in reverse.settled:
        for more, _, to in _reverse(node, rows):
            if to in forward.settled:
                best = min(best, reverse.cost[node] + more + forward.cost[to])
    while forward.least() + reverse.least() <= best:
        side, other = (forward, reverse) if forward.least() <= reverse.least() else (reverse, forward)
        node, met = side.settle()
        for cost, to in met:
            if to in other.settled:
                best = min(best, cost + other.cost[to])
    crossings = []
    for node in forward.settled:
        cost = forward.cost[node]
        if node in ends and cost == best:
            crossings.append("".join(_unrolled(forward.audit[node])[::-1]))
        for more, edit, to in _forward(node, rows):
            if to in reverse.settled and to not in forward.settled and cost + more + reverse.cost[to] == best:
                crossings.append("".join([*_unrolled(forward.audit[node])[::-1], edit, *_unrolled(reverse.audit[to])]))
    return int(best), min(crossings)


def roles_after(initials: list[str], audit: str) -> list[tuple[int, str]]:
    """For each row of the repaired conversation, the row it was (-1: inserted) and its new role ('': as it was)."""
    out, state, i = [], 0, 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            x, role = initials[i], ""
        else:
            x = next(y for y in ROLES if state in STEPS[y])
            role = ROLES[x]
        out.append((-1 if edit == "I" else i, role))
        state = STEPS[x][state]
        i += edit != "I"
    return out


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` with the first fault of each: blank, duplicate, truncated or empty.

    One shuffle by conversation serves the window here and the sums after it.
    """
    order = Window.partitionBy("conv", "there", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())
    return rows.repartition("conv").withColumn(
        "fault",
        F.when(~F.col("text").rlike(SIGN), "blank")
        .when(F.row_number().over(order) > 1, "duplicate")
        .when(~F.col("text").rlike(FINISHED), "truncated")
        .otherwise(""),
    )


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    dropped_col: str | None = None,
) -> DataFrame:
    """For every conversation: counts of faults, cost, audit and the ``repaired`` turns (role, text).

    dropped_col: a boolean column of rows that don't count, but whose conversation is to be told even if all its rows are so.
    """
    shown = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    rows = turns.select(
        column(conv_col).alias("conv"),
        column(turn_col).alias("turn"),
        shown(role_col).alias("role"),
        shown(text_col).alias("text"),
        (~F.coalesce(column(dropped_col), F.lit(False)) if dropped_col else F.lit(True)).alias("there"),
    )
    told = F.when(F.col("there"), F.struct("turn", "role", "text", "fault"))
    # Equal rows are in order by fault as well: the first one has none.
    by_conv = _faults(rows).groupBy("conv").agg(F.sort_array(F.collect_list(told)).alias("turns"))
    having = lambda fault: F.size(F.filter("turns", lambda t: t.fault == fault)).cast("long").alias(fault)
    placed = F.filter(F.transform("turns", lambda t: t.turn), lambda t: t.isNotNull())
    pairs = F.when(
        F.size("turns") > 1,
        F.transform(
            F.sequence(F.lit(1), F.size("turns") - 1),
            lambda i: F.concat(*[F.substring(F.get("turns", j).role, 1, 1) for j in (i - 1, i)]),
        ),
    ).otherwise(F.array().cast("array<string>"))
    codes = by_conv.select(
        "conv",
        F.coalesce(F.array_max(placed) - F.array_min(placed) + 1 - F.size(F.array_distinct(placed)), F.lit(0)).cast("long").alias("gaps"),
        *[having(x) for x in ("blank", "duplicate", "truncated")],
        F.size(F.filter(pairs, lambda p: ~p.isin(LEGAL))).cast("long").alias("illegal"),
        F.transform("turns", lambda t: F.substring(t.role, 1, 1)).alias("initials"),
        F.transform("turns", lambda t: F.when(t.fault == "truncated", 2).when(t.fault == "", 0).otherwise(1)).alias("faults"),
        F.transform("turns", lambda t: F.struct(t.role, t.text)).alias("said"),
    )
    schema = StructType([*codes.schema.fields, *StructType.fromDDL("cost long, audit string, taken array<int>, roles array<string>").fields])

    def run(batches):
        edits = lru_cache(1 << 16)(cheapest)
        for batch in batches:
            columns = cost, audit, taken, roles = [], [], [], []
            for initials, faults in zip(batch.column("initials").to_pylist(), batch.column("faults").to_pylist(), strict=True):
                price, said = edits(tuple(zip(initials, faults, strict=True)))
                after = roles_after(initials, said)
                for values, value in zip(columns, (price, said, [i for i, _ in after], [r for _, r in after]), strict=True):
                    values.append(value)
            kinds = pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())
            made = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    new = F.transform(
        F.arrays_zip("taken", "roles"),
        lambda x: F.struct(
            F.when(x.roles == "", F.get("said", x.taken).role).otherwise(x.roles).alias("role"),
            F.when(x.taken < 0, "").otherwise(F.get("said", x.taken).text).alias("text"),
        ),
    )
    told = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return codes.mapInArrow(run, schema).select(F.col("conv").alias(conv_col), *told, new.alias("repaired"))


def repaired_text() -> Column:
    """The repaired turns as ``role:text``, a line break between them."""
    return F.array_join(F.transform("repaired", lambda t: F.concat(t.role, F.lit(":"), t.text)), "\n")
