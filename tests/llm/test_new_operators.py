"""Fill-in-middle, conversation repair and toxicity against brute force, round trips and held-out labels."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from placelens.llm import fim, queries, repair, toxicity
from tests.llm.test_llm import DOC, SF, documents, odd_documents, prose, sql

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark)


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_repair"])
def test_sql_twin(spark, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), sql(name)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) == len(want)
    plain = lambda df: sorted(repr(tuple(None if pd.isna(x) else x for x in r)) for r in df[columns].astype(object).values.tolist())
    assert [x.replace(".0", "") for x in plain(got)] == [x.replace(".0", "") for x in plain(want)]


def test_all_thirteen_are_registered():
    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in entry.queries()}


# 11. Fill-in-middle.

TEXTS = [None, "", " ", "\n\t ", "a", " a", "a ", "a b", "é　\x0bñ  x\r\n", "<P>", "x <M y", "<S <P <M", "< S>", "\U0001f600 b c ", prose(3, 20_000), "z" * 300_000, "q <S> q"]


def brute_fim(doc_id, text, percent, spm_percent):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("percent", "spm_percent"), [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_outputs_match_brute_force_and_are_undone(spark, percent, spm_percent):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a b c d"), (None, None), (2**62, "one two three "), (3, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fim.restore(fim.transform(docs, percent=percent, spm_percent=spm_percent)).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    for r, (doc_id, text) in zip(sorted(got, key=key), sorted(rows, key=key), strict=True):
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_fim(doc_id, text, percent, spm_percent)
        assert r.restored == (text or "")


def test_rotations_exchange_blocks_in_place():
    for a, b, c in itertools.product(range(4), repeat=3):
        block = bytearray(b"x" + b"a" * a + b"b" * b + b"c" * c)
        fim.rotate(block, 1 + a, 1 + a + b, len(block))
        assert block == b"x" + b"a" * a + b"c" * c + b"b" * b


def test_fim_on_odd_rows(spark, odd):
    out = fim.transform(odd.withColumn("form", odd.lang))
    assert out.columns[: len(odd.columns) + 1] == [*odd.columns, "form"] and out.columns[-1] == "output" and "form_" in out.columns and "n_" in out.columns
    assert out.count() == odd.count()
    back = fim.restore(out, form_col="form_").select("text", "restored").collect()
    assert all(r.restored == (r.text or "") for r in back)
    assert fim.transform(odd.limit(0)).count() == 0


# 12. Conversation repair.


def brute_repair(rows):
    """The least (cost, audit) over all edit sequences, row by row."""
    steps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for x in "ua":
                    if (x, state) in steps:
                        offer(best, steps[x, state], cost + 3, audit + "I")
        return best

    def offer(best, state, cost, audit):
        best[state] = min(best.get(state, (math.inf, "")), (cost, audit))

    best = with_inserts({0: (0, "")})
    for initial, fault in rows:
        new = {}
        for state, (cost, audit) in best.items():
            offer(new, state, cost + 4, audit + "D")
            for x in "sua" if fault != 1 else "":
                if (x, state) in steps and (x == initial or x != "s"):
                    edit, price = ("K", 0) if x == initial else ("R", 3)
                    offer(new, steps[x, state], cost + price + 3 * (fault == 2), audit + edit)
        best = with_inserts(new)
    return min(best[x] for x in (0, 3) if x in best)


def test_cheapest_edits_match_brute_force():
    r = random.Random(4)
    for _ in range(4000):
        rows = tuple((r.choice(["s", "u", "a", "u", "a", "t", "", " "]), r.choice([0, 0, 0, 1, 2])) for _ in range(r.randrange(11)))
        assert repair.cheapest(rows) == brute_repair(rows)
    for share in (0.0, 0.5):
        long = tuple((r.choice("sua") if r.random() < share else "ua"[i % 2], 0) for i in range(3000))
        assert repair.cheapest(long) == brute_repair(long)


def brute_conversation(rows):
    """rows (turn, role, text): gaps, faults, illegal, cost, audit and the repaired turns."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    codes = {"": 0, "truncated": 2}
    cost, audit = brute_repair([(x, codes.get(f, 1)) for x, f in zip(initials, faults, strict=True)])
    said, i, state = [], 0, ""
    for edit in audit:
        role, text = rows[i][1:] if edit != "I" else ("", "")
        if edit in "RI":
            role = "assistant" if state == "u" else "user"
        if edit != "D":
            said.append((role, text))
            state = role[0]
        i += edit != "I"
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, said


def test_repair_of_odd_conversations(spark):
    r = random.Random(6)
    table = []
    for conv in [*range(120), None]:
        for _ in range(r.randrange(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Übel"])
            text = r.choice([None, "", " \t", "Yes.", "No", "So?", "Ende! \n", "　", "a" * 50_000, ".", "é.\x0b", f"t{r.random()}."])
            table.append((conv, r.choice([None, 0, 1, 2, 3, 9]), role, text))
    table += table[:20]
    turns = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumns({"cost": repair.F.lit(1), "fault": repair.F.lit("x")})
    got = {x.conv_id: x for x in repair.repair(turns).collect()}
    assert set(got) == {x[0] for x in table}
    for conv, x in got.items():
        want = brute_conversation([row[1:] for row in table if row[0] == conv])
        assert (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, [(t.role, t.text) for t in x.repaired]) == want
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in x.repaired))
    assert repair.repair(turns.limit(0)).count() == 0


def test_damage_and_conversations_that_lose_all_rows(spark):
    harm = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    table = [(c, t, "assistant", "a. b!") for c in [*range(200), None] for t in (None, 0, 1)]
    turns = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    got = repair.damaged(turns).collect()
    for c, t, _, _ in table:
        own = [x for x in got if (x.conv_id, x.turn) == (c, t)]
        h = harm(c, t)
        assert len(own) == 1 + (h == 3) and {x.dropped for x in own} == {h == 0}
        assert {x.text for x in own} == {{1: "", 2: "a b"}.get(h, "a. b!")} and {x.role for x in own} == {"user" if h == 4 else "assistant"}
    lone = [(c, 0, "user", "x.") for c in range(400) if harm(c, 0) == 0][:3]
    out = repair.repair(repair.damaged(spark.createDataFrame(lone, turns.schema)), dropped_col="dropped").collect()
    assert len(out) == 3 and all((x.gaps, x.blank, x.illegal, x.cost, x.audit, x.repaired) == (0, 0, 0, 0, "", []) for x in out)


# 13. Toxicity.


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_toxicity(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert set(held.doc_id) == {i for i in got.doc_id if zlib.crc32(str(i).encode()) % 5 == 0}
    # Of the labelled toxic texts about one in ten has no expression of any training text.
    assert held.predicted[held.toxic == 1].mean() > 0.8 and held.predicted[held.toxic == 0].mean() < 0.08


def brute_probability(runs, own):
    """P(last byte | bytes before) of class counts ``own`` over shared continuation counts, from dictionaries of bytes."""

    def discount(counts):
        ones, twos = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    tables, longer = {}, set(runs)
    for order in range(toxicity.ORDER - 1, 0, -1):
        tables[order] = {}
        for run in longer:
            tables[order][run[-order:]] = tables[order].get(run[-order:], 0) + 1
        longer = set(tables[order])

    def interpolated(counts, run, shorter):
        followers = {r: c for r, c in counts.items() if r[:-1] == run[:-1]}
        total, d = sum(followers.values()), discount(counts)
        if not total:
            return shorter
        return (max(counts.get(run, 0) - d, 0) + d * len(followers) * shorter) / total

    def shared(run):
        return interpolated(tables[len(run)], run, shared(run[1:])) if run else 1 / toxicity.SYMBOLS

    return lambda run: interpolated(own, run, shared(run[1:]))


def test_log_ratios_match_a_plain_kneser_ney_model():
    texts = {1: ["you fool fool of fools", "Foolish idea foo"], 0: ["a good idea", "the food is good, the pool cool"]}
    counts = {}
    for y, own in texts.items():
        counts[y] = {}
        for word in " ".join(own).lower().split():
            padded = bytes(toxicity.ORDER - 1) + word.encode() + b" "
            for i in range(toxicity.ORDER, len(padded) + 1):
                run = padded[i - toxicity.ORDER : i]
                counts[y][run] = counts[y].get(run, 0) + 1
    runs = set(counts[0]) | set(counts[1])
    one, other = (brute_probability(runs, counts[y]) for y in (1, 0))
    model = toxicity.conditional(*(toxicity.counted(pa.array(texts[y])) for y in (1, 0)))
    asked = sorted(runs) + [bytes(toxicity.ORDER - 4) + b"fooq"[:4], bytes(toxicity.ORDER - 1) + b"z", b"unknowns"[: toxicity.ORDER]]
    got = model.of_runs(np.array([int.from_bytes(r, "big") for r in asked], np.uint64))
    assert got == pytest.approx([math.log(one(r)) - math.log(other(r)) for r in asked])
    assert got[-1] == 0
    # A text's difference is that of its most toxic two words, by their bytes and end marks.
    of = lambda word: sum(math.log(one(r)) - math.log(other(r)) for r in spelled(word))
    spelled = lambda w: [(bytes(toxicity.ORDER - 1) + w.encode() + b" ")[i : i + toxicity.ORDER] for i in range(len(w) + 1)]
    words = ["the", "fool", "is", "a", "fools"]
    want = max((of(a) + of(b)) / (len(a) + len(b) + 2) for a, b in itertools.pairwise(words))
    want = max(want, of("the") / 4)
    assert model.differences(pa.array([" ".join(words), None, " "])) == pytest.approx([want, 0, 0])


def test_probabilities_of_a_history_sum_to_one():
    model = toxicity._Counts(*toxicity.counted(pa.array(["abc abd abd b"])))
    runs, shorter = model.keys, np.full(len(model.keys), 1 / toxicity.SYMBOLS)
    for history in model.histories:
        own = runs >> np.uint64(8) == history
        seen = model.probability(runs, shorter)[own].sum()
        assert seen + model.rest(np.array([history]))[0] * (toxicity.SYMBOLS - own.sum()) / toxicity.SYMBOLS == pytest.approx(1)


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (8, 0), (9, 0), (9, 0), (2, None), (10, 1), (10, 0), (None, 1), (77, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.id in (3, 4, 5)}) == 1
    for useless in (labels.limit(0), labels.where("toxic = 1")):
        assert {(r.score, r.predicted) for r in toxicity.score(odd, toxicity.train(odd, useless)).collect()} == {(0.5, 1)}
    assert toxicity.score(spark.createDataFrame([], DOC), toxicity.train(odd.limit(0), labels)).count() == 0


def test_the_sample_bounds_each_class(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    small, whole = (toxicity.train(docs, labels, sample=n) for n in (3, 8000))
    assert 0 < len(small.runs) < len(whole.runs)
