"""The corpus operators against brute force, round trips and held-out labels, on small tables and odd rows."""

import glob
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from placelens.llm import chat, decontaminate, jaccard, knn, lm, mixing, quality, shared, spans, urls, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, name=SF):
    return spark.read.parquet(f"{name}/documents.parquet")


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(5000)}" + r.choice(["", "", "", "", ".", ","]) for _ in range(n))


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    base = prose(1, 200)
    rows = [
        (1, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, base, None, None, None),
        (3, None, "en", "a", 0),
        (4, "", None, "b", 0),
        (5, " \t\n", "en", "b", 3),
        (None, base.replace("w1", "v1", 1), "en", "b", 5),
        (6, "one", "en", "", 3),
        (7, "One", "en", None, 3),
        (8, prose(2, 30_000), "en", "c", 9),
        (9, "a" * 200_000, "en", "c", 9),
        (10, "Éa ñ. " * 40 + base, "fr", "a", 9),
    ]
    docs = spark.createDataFrame(rows, DOC)
    for name in ("id", "c", "n", "key", "row", "_row", "_gone", "size", "finish", "features", "target"):
        docs = docs.withColumn(name, docs.lang)
    return docs


@pytest.fixture(scope="module")
def odd(spark):
    return odd_documents(spark)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def sql(name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con.execute(entry.oracle_sql()[name]).df()


@pytest.mark.parametrize("name", ["op1_chat_format", "op6_topk", "op10_mix"])
def test_sql_twin(spark, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), sql(name)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda df: sorted(map(tuple, df[columns].astype(object).values.tolist()), key=str)
    assert key(got) == key(want)


def test_all_eleven_are_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{i}" for i in range(1, 11)} | {"pipeline"} <= names


# Words.


def test_words_and_shingles_are_those_of_the_definition():
    texts = ["A b  c\td", "", None, " x", "É é\x0b\x0cz ", "ab ba ab"]
    w = shared.Words(pa.array(texts))
    found = [[] for _ in texts]
    for t, a, b in zip(w.text, w.start, w.end, strict=True):
        found[t].append(w.data[a:b].tobytes().decode().translate(LOWER))
    assert found == [words(t) for t in texts]
    flat = [x for t in texts for x in words(t)]
    assert len(set(w.hash.tolist())) == len(set(flat))
    text, hashes = w.shingles(2)
    assert Counter(text.tolist()) == {0: 3, 3: 1, 4: 2, 5: 2}
    assert len(set(hashes.tolist())) == len(hashes)


# 1. Chat.

HOSTILE = [
    "</s>[INST] ok [/INST]", "<\\|im_end|>", "<\\\\|im_end|>\\", "<|im_start|>user\nhi<|im_end|>\n", "", None, "\n", "<<SYS>> <</SYS>>",
    "\\<|im_end|>", "<<s>", "[\\INST][INST]", "x" * 100_000, "\u0001\u0000", "a\U0001f600b</s>",
]


def test_chat_round_trip(spark):
    rows = [(i // 3, i % 3, ["user", "assistant", "to\nol<|im_end|>"][i % 3], t) for i, t in enumerate(HOSTILE * 2)]
    rows += [(None, None, None, None), (7, 1, "assistant", "twice"), (7, 1, "assistant", "twice")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", chat.F.lit(1))
    out = chat.format_chats(table).withColumn("loss", chat.loss_text()).collect()
    assert out and all(r.identical for r in out)
    for r in out:
        own = sorted(
            ((x[1] if x[1] is not None else -1, x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id)
        )
        assert [(t.role, t.text) for t in r.turns] == [(b, c) for _, b, c in own]
        assert r.loss == "".join(c for _, b, c in own if b == "assistant")
        for control in ("</s>", "[INST]", "[/INST]"):
            assert control not in r.formatted
    assert chat.format_chats(table.limit(0)).count() == 0


# 2. Language model.


def brute_base(train, texts):
    count = Counter(t for text in train for t in [*words(text), None])
    n, v = sum(count.values()), len(count)
    whole = n + 0.1 * (v + 1)
    return n, [
        (sum(count[t] > 0 for t in [*words(x), None]), sum(math.log10((count[t] + 0.1) / whole) for t in [*words(x), None]))
        for x in texts
    ]


@pytest.mark.parametrize("exact", [lm.EXACT, 0.01])
def test_unigram_baseline_is_exact(spark, odd, exact):
    rows = odd.select("doc_id", "text").collect()
    train = odd.where("doc_id <> 9").select("text")
    n, want = brute_base([r.text for r in train.collect()], [r.text for r in rows])
    scored = lm.score(odd, lm.train(train, counted := lm.count_words(train)))
    got = scored.join(lm.unigram_baseline(odd, counted, exact=exact), "row").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    plain = sorted([(r.doc_id, k, round(b, 6), n) for r, (k, b) in zip(rows, want, strict=True)], key=key)
    assert sorted([(r.id, r.n_known, round(r.base_score, 6), r.train_tokens) for r in got], key=key) == plain


def test_probabilities_sum_to_at_most_one(spark):
    rows = [(f"a b c d e f g {x} b c",) for x in "hijklmnop"] * 3
    train = spark.createDataFrame(rows, "text string")
    model = lm.train(train, lm.count_words(train))
    vocabulary = sorted({t for (x,) in rows for t in words(x)})
    for history in ("", "a ", "a b ", "zz ", "b c "):
        texts = [history + x for x in vocabulary] + [history + "unseen"]
        w = shared.Words(pa.array(texts))
        text, logs = model.log_probabilities(w)
        place = w.per_text - 1
        last = np.array([logs[text == i][place[i]] for i in range(len(texts))])
        end = logs[text == 0][-1] if not history else model.log_probabilities(shared.Words(pa.array([history])))[1][-1]
        total = (10.0**last).sum() + (10.0**end if history else 0)
        assert total <= 1.02, history


def test_model_beats_unigrams_on_held_out_texts(spark):
    got = entry.queries()["op2_lm_score"](spark, SF).toPandas()
    held = got[got.held_out]
    assert set(held.doc_id) == {i for i in got.doc_id if zlib.crc32(str(i).encode()) % 10 == 0}
    assert held.score.sum() > held.base_score.sum()


def test_bloom_filter_bounds_and_levels(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key", "0 AS salt")
    bits = shared.build_bloom(keys, shared.segments_for(5000))
    inside = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    assert shared.bloom_probe(bits, inside).all()
    assert shared.bloom_probe(bits, shared.mix(np.arange(20_000, dtype=np.uint64))).mean() < 0.02


def test_models_larger_than_a_broadcast_give_the_same(spark, odd, monkeypatch):
    docs = documents(spark).select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    train = docs.select("text")
    model = lm.train(train, lm.count_words(train))
    usual = sorted((r.row, round(r.score, 6)) for r in lm.score(docs, model).collect())
    monkeypatch.setattr(lm, "MOST_SEGMENTS", 2)
    parts = lm.train(train, lm.count_words(train))
    assert not parts.filters and len(parts.parts()) > 1
    assert usual == sorted((r.row, round(r.score, 6)) for r in lm.score(docs, parts).collect())


def test_packed_ngrams_score_as_the_filters_do(spark, odd, monkeypatch):
    docs = documents(spark).select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    train = docs.where("doc_id % 3 <> 0").select("text")
    for name, small in {"TOGETHER": 5000, "BUCKET": 3000, "CHUNK": 40_000, "ASKED": 2000}.items():
        monkeypatch.setattr(lm, name, small)
    model = lm.train(train, lm.count_words(train))
    count = Counter()
    for (text,) in train.collect():
        tokens = [None, *words(text), "</s>"]
        count.update(zip(tokens, tokens[1:]))
        count.update(zip(tokens[1:], tokens[2:], tokens[3:]))
    levels = [sum(int(t) <= n for t in model.thresholds[:-1]) for k, n in count.items() if len(k) == 3]
    assert model.segments[2] == shared.segments_for(sum(levels))
    rows = lm._keyed(docs, "doc_id", "text").collect()
    text, logs = model.log_probabilities(shared.Words(pa.array([r.text for r in rows])))
    want = sorted(zip([r.row for r in rows], np.bincount(text, logs).round(6)))
    assert want == sorted((r.row, round(r.score, 6)) for r in lm.score(docs, model).collect())


def test_scoring_leaves_no_copies_of_the_texts(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(shared, "new_folder", lambda _, name: made.append(tmp_path / f"{len(made)}" / name) or str(made[-1]))
    docs = documents(spark).select("doc_id", "text")
    train = docs.select("text")
    model = lm.train(train, lm.count_words(train))
    lm.score(docs, model)
    kept = sorted(x.name for x in made if x.exists())
    assert kept == ["filter", "filter", "filter", "scores", "words"]


def test_cut_texts_count_and_score_as_texts_do(spark, odd, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 40_000)
    docs = documents(spark).select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    docs = docs.unionByName(odd.select("doc_id", "text"))
    fold = F.coalesce(F.col("doc_id"), F.lit(0)) % 3
    first, others = lm.cut(docs.where(fold != 0)), lm.cut(docs.where(fold == 0))
    found = []
    for train, texts in ((docs.where(fold != 0).select("text"), docs), (first, first.unionByName(others))):
        words = lm.count_words(train)
        scored = lm.score(texts, lm.train(train, words)).selectExpr("id", "row", "n_tokens", "round(score, 6)")
        base = lm.unigram_baseline(texts, words).selectExpr("row", "n_known", "round(base_score, 6)", "train_tokens")
        found.append([Counter(map(tuple, df.collect())) for df in (words, scored, base)])
    assert found[0] == found[1] and first.count() > 1
    # Tokens take less room than the texts did.
    size = first.selectExpr("sum(length(words) + length(tokens) + length(lengths))").first()[0]
    assert size < docs.where(fold != 0).selectExpr("sum(octet_length(text))").first()[0]


def test_ngrams_are_hashed_in_runs(monkeypatch):
    texts = pa.array([prose(i) for i in range(5)] + [None, "", "a", "a b"])
    hashes, _, place = lm._sequence(shared.Words(texts))
    words, index = np.unique(hashes, return_inverse=True)
    chunk = lm._Chunk(words, index, shared.Words(texts).per_text + 1)
    for run in (1, 7, 1 << 15):
        monkeypatch.setattr(lm, "RUN", run)
        for n in (1, 2, 3, 5):
            assert (chunk.keys(n) == lm._ngrams(hashes, place, n)).all()
    assert (chunk.word_keys[index] == chunk.keys(1)).all()


def test_few_large_rows_are_in_memory_at_a_time(spark):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(name) for name in names]
    rows = spark.range(0, 80, 1, 1).selectExpr(f"cast(repeat('x', {1 << 19}) as binary) AS keys")

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    with shared.Scope():
        sent = [r.n for r in lm._stored(rows.mapInArrow(count, "n long"), "counts").collect()]
        stored = lm._stored(rows, "levels", **lm._LARGE_ROWS)
        read = [r.n for r in lm._stored(stored.mapInArrow(count, "n long"), "counts").collect()]
        groups = [
            file.row_group(i).total_byte_size
            for file in (pq.ParquetFile(f).metadata for f in glob.glob(f"{stored.scratch}/*.parquet"))
            for i in range(file.num_row_groups)
        ]
    assert sum(sent) == sum(read) == 80 and max(sent + read) <= lm.BATCH >> 18
    assert sum(groups) >= 40 << 20 and max(groups) <= 20 << 20
    assert before == [spark.conf.get(name) for name in names]


def test_rare_words_are_kept_at_any_size(spark):
    rare = spark.createDataFrame([("seldom seen words",)], "text string")
    often = spark.range(20_000).selectExpr("repeat('very common words here ', 150) AS text")
    train = rare.unionByName(often)
    words = shared.Words(pa.array(["seldom seen words", "never met terms"]))
    text, logs = lm.train(train, lm.count_words(train)).log_probabilities(words)
    assert logs[text == 0][0] > logs[text == 1][0] + 0.5 and logs[text == 0][1] > logs[text == 1][1] + 3


def test_lm_without_training(spark, odd, none):
    train = none.select("text")
    scored = lm.score(odd, lm.train(train, counted := lm.count_words(train)))
    assert scored.count() == odd.count()
    assert {r.n_known for r in lm.unigram_baseline(odd, counted).collect()} == {0}
    assert lm.score(none, lm.train(train, counted)).count() == 0


# 3. Urls.

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_url_rules_and_trees(spark):
    odd_urls = [None, "", "x", "http://", "http://Net/", "http://net", "HTTPS://A.Example.NET/en/x?y=/#z", "a://b://c/d", "http://example.netx/en/",
                "http://h.org/fr/\n?q", "http://é.org/fr/%20", "http://x.net?a/b", "http://u@x.example.com:80/de/", "http://" + "a" * 5000 + ".net/"]
    rows = [(i, u) for i, u in enumerate(odd_urls)] + [(1, ""), (None, "http://a.net/")]
    rows += [(100 + i, f"http://s{i}.example.{['com', 'net', 'org'][i % 3]}/{['de', 'en', 'fr'][i % 5 % 3]}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": urls.F.lit(1), "part": urls.F.lit("x")})
    got = urls.judge(pages, RULES).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter((i, *brute_rule(u)[:3]) for i, u in rows)
    assert all(r.verdict == {**{k[0] + k[1]: k[2] for k in RULES}}[r.rule] for r in got if r.rule)
    assert {r.verdict for r in got} == {"allow", "block"}
    assert urls.judge(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}


def test_trees_on_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    url = urls.column("url")
    rows = pages.select("page_id", "url", urls.host_of(url).alias("host"), urls.path_of(url).alias("path"))
    rule, says = urls.fitting_rule(urls.F.col("host"), urls.F.col("path"), RULES)
    labelled = rows.withColumn("blocked", (says == "block").cast("int")).where("blocked is not null")
    model = urls.fit(labelled.where("page_id % 4 <> 0"))
    held = model.block_share(labelled.where("page_id % 4 = 0")).toPandas()
    assert ((held.p_block >= 0.5) == held.blocked).mean() > 0.9
    assert "Python" not in urls.judge(pages, RULES, model)._jdf.queryExecution().executedPlan().toString()


def test_trees_judge_urls_of_folders_without_labels(spark):
    """Lexical features count, urls that no rule decides are told apart, and labels of unseen folders are found by them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    got = urls.judge(pages, RULES).where("rule is null").toPandas()
    assert len(got) > 100 and got.p_block.round(3).nunique() > 10
    r = random.Random(3)
    rows = []
    for i in range(3000):
        bad = i % 2
        slug = "".join(r.choice("0123456789" if bad and r.random() < 0.6 else "abcdefgh") for _ in range(12))
        query = "?" + "&".join(f"k{j}={r.randrange(99)}" for j in range(r.randrange(3, 7))) if bad else ""
        rows.append((f"http://s{r.randrange(9)}.org/f{i % 40}/{slug}{query}", "s.org", f"/f{i % 40}/{slug}", bad if r.random() < 0.97 else 1 - bad))
    table = spark.createDataFrame(rows, "url string, host string, path string, blocked int")
    known = urls.F.regexp_extract("path", "/f([0-9]+)/", 1).cast("int") < 30
    model = urls.fit(table.where(known))
    weights = model.trees.featureImportances.toArray()
    assert sum(w > 0.01 for w, n in zip(weights, urls.FEATURES, strict=True) if not n.endswith(("_n", "_share"))) >= 2
    held = model.block_share(table.where(~known)).toPandas()
    assert ((held.p_block >= 0.5) == held.blocked).mean() > 0.9


def test_a_learned_url_does_not_see_its_own_label(spark):
    rows = [(f"http://only{i}.net/f{i}/x", f"only{i}.net", f"/f{i}/x", i % 2) for i in range(60)]
    labelled = spark.createDataFrame(rows, "url string, host string, path string, blocked int")
    model = urls.fit(labelled)
    seen = model.featured(labelled, learned=True).collect()
    assert {(r.domain_n, r.folder_n) for r in seen} == {(0.0, 0.0)} and {r.domain_share for r in seen} == {0.5}
    fold = {r.url: r.fold for r in labelled.select("url", urls.fold_of(urls.F.col("url")).alias("fold")).collect()}
    for r in seen:
        others = [b for u, _, _, b in rows if fold[u] != fold[r.url]]
        assert r.suffix_n == len(others) and math.isclose(r.suffix_share, (sum(others) + 10) / (len(others) + 20))


def test_url_statistics_are_of_all_labels(spark, monkeypatch):
    rows = [(f"http://a{i % 50}.net/f{i % 3}/{i}", f"a{i % 50}.net", f"/f{i % 3}/{i}", int(i % 50 < 20)) for i in range(400)]
    labelled = spark.createDataFrame(rows, "url string, host string, path string, blocked int")
    model = urls.fit(labelled, sample=20)
    got = model.featured(labelled).select("url", "suffix_n", "suffix_share", "domain_n", "domain_share", "folder_n", "folder_share")
    seen = {r.url: r for r in got.collect()}
    assert len(seen) == 400 and {(r.suffix_n, r.domain_n) for r in seen.values()} == {(400.0, 8.0)}
    for url, host, path, blocked in rows:
        folder = [b for _, _, p, b in rows if p.split("/")[1] == path.split("/")[1]]
        assert seen[url].folder_n == len(folder)
        assert math.isclose(seen[url].folder_share, (sum(folder) + 20 * 0.4) / (len(folder) + 20))
        assert math.isclose(seen[url].domain_share, (8 * blocked + 20 * 0.4) / 28)
    monkeypatch.setattr(urls, "MOST_PARTS", 0)
    assert sorted(map(tuple, model.featured(labelled).select(got.columns).collect())) == sorted(map(tuple, seen.values()))


# 4. Decontamination.


def test_reparameterised_items_are_leaks(spark):
    items = [(1, "On Monday morning Anna buys 12 apples and 7 pears for 30 dollars, then Anna walks 5 km home with 12 apples."),
             (2, "too short item"), (3, None), (4, ""), (1, "On Monday morning Anna buys 12 apples and 7 pears for 30 dollars, then Anna walks 5 km home with 12 apples.")]
    same = items[0][1]
    other = same.replace("Anna", "Otto").replace("12", "99").replace("7", "three").replace("km", "miles")
    mixed = other.replace("99 apples.", "41 apples.").replace("then Otto", "then Emma")
    rows = [(10, f"Before it. {same} After"), (11, f"before {other} after"), (12, f"before {mixed} after"), (13, prose(5)), (14, None),
            (15, ""), (16, same.upper()), (17, "This is too short item"), (17, "x"), (None, other), (10, f"Before it. {same} After")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"slots": spans.F.lit(1), "hash": spans.F.lit(1)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.verbatim for r in decontaminate.leaks(docs, bench).collect()}
    assert set(got) >= {(10, 1), (11, 1), (None, 1)} and got[10, 1] and not got[11, 1]
    assert not {(12, 1), (13, 1), (14, 1), (15, 1)} & set(got)
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {12, 13, 14, 15}
    assert decontaminate.leaks(docs, bench.limit(0)).count() == decontaminate.leaks(docs.limit(0), bench).count() == 0


def leaked(spark, items, docs):
    """Pairs (document, item) of leaks, by place in the lists of texts."""
    tables = [spark.createDataFrame(list(enumerate(x)), f"{name} long, text string") for x, name in ((docs, "doc_id"), (items, "item_id"))]
    return {(r.doc_id, r.item_id): r.verbatim for r in decontaminate.leaks(*tables).collect()}


def test_items_shorter_than_a_window(spark):
    items = ["too short item", "How many are 5 apples?", "solitary", "What is 12 times 7, please tell me now"]
    docs = [f"{prose(7)} this is too short, item {prose(8)}", f"{prose(9)}. How many are 9 apples? {prose(10)}", "too short item", "Solitary",
            f"{prose(11)} too short an item", prose(12)]
    assert leaked(spark, items, docs) == {(0, 0): True, (1, 1): False, (2, 0): True, (3, 2): True}


def test_items_in_other_case(spark):
    items = ["On Monday morning Anna buys 12 apples and 7 pears for 30 dollars, then Anna walks 5 km home with 12 apples.",
             "Painters often keep their brushes in clear water"]
    docs = [items[0].upper(), f"{prose(13)} {items[0].lower()} {prose(14)}", items[0].upper().replace("12", "99"), f"so said {items[1]} {prose(15)}",
            items[0].upper().replace("12 APPLES AND", "99 APPLES AND"), items[0].replace("Anna", "Otto", 1).replace("12", "13", 1).replace("7", "8")]
    got = leaked(spark, items, docs)
    assert {k: got.get(k) for k in ((0, 0), (1, 0), (2, 0), (3, 1))} == {(0, 0): True, (1, 0): True, (2, 0): False, (3, 1): True}
    assert (5, 0) not in got


def test_items_of_numbers_and_names(spark):
    items = ["What is 12 * 7 + 45 - 3 * 8 + 19?", "Guests: Anna Otto Emma Paul Rosa Karl Lena Hugo Ida", "42",
             "The red boat sails off with 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22"]
    docs = [f"{prose(16)}. {items[0]} {prose(17)}", f"so {items[1].upper()} {prose(18)}", "she said 42 again", "she said 43 again",
            items[0].replace("19", "20").replace("45", "46").replace("12", "13").replace("7", "9"),
            "The red boat sails off with 33 44 55 66 77 88 99 100"]
    assert leaked(spark, items, docs) == {(0, 0): True, (1, 1): True, (2, 2): True, (5, 3): False}


def test_verbatim_but_for_one_value(spark):
    item = "Anna had 12 red and green apples in a very old basket by the door of her small white house, and so Otto took all 12 of them."
    docs = [item.replace("took all 12", "took all 21"), item.replace("12", "15"), item.replace("had 12", "had 15").replace("Otto", "Anna"), prose(19)]
    assert leaked(spark, [item], docs) == {(0, 0): False, (1, 0): False, (2, 0): False}


def test_large_benchmarks_give_the_same(spark, monkeypatch):
    docs, bench = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    usual = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "MOST_WINDOWS", 0)
    assert usual == sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))


# 5. Spans.


def cut_long(sentence):
    """Sentences of over 16 words, cut by word hashes."""
    if len(sentence) <= 16:
        return [sentence]
    hashes = shared.Words(pa.array([" ".join(sentence)]), lower=False).hash
    pieces = [[sentence[0]]]
    for i in range(1, len(sentence)):
        pieces[-1].append(sentence[i])
        pair = shared.mix(hashes[i : i + 1] ^ shared.mix(hashes[i - 1 : i]))[0]
        if (sentence[i] == sentence[i - 1] or int(pair) % 4 == 0) and i + 1 < len(sentence):
            pieces.append([])
    return pieces


def brute_spans(rows, sentences=2, least=20):
    """Rows (id, text) by id: the words kept, by sentences."""
    seen, out = {}, []
    for doc, text in rows:
        parts = [p for p in re.split(r"(?<=[.!?,;:])[\x20\x09-\x0D]+|\n", text or "") if WORD.search(p)]
        own = [piece for p in parts for piece in cut_long(WORD.findall(p))]
        gone = set()
        for i in range(len(own)):
            e = i
            while e < len(own) and (e - i + 1 < sentences or sum(map(len, own[i : e + 1])) < least):
                e += 1
            if e < len(own):
                key = tuple(map(tuple, own[i : e + 1]))
                if seen.setdefault(key, (doc, i)) != (doc, i):
                    gone |= set(range(i, e + 1))
        out.append((doc, [w for j, s in enumerate(own) if j not in gone for w in s], len(gone)))
    return out


def test_spans_match_brute_force(spark):
    rows = sorted(map(tuple, documents(spark).select("doc_id", "text").collect()))
    got = {r.doc_id: (WORD.findall(r.text), r.n_removed) for r in spans.drop_repeated_spans(documents(spark)).collect()}
    assert {d: (w, n) for d, w, n in brute_spans(rows)} == got
    assert any(n for _, n in got.values())


def test_spans_without_stops_and_within_other_sentences(spark):
    r = random.Random(9)
    word = lambda n: " ".join(f"q{r.randrange(10**6)}" for _ in range(n))
    passage, other = word(60), word(200)
    rows = [
        (1, f"{word(30)} {passage} {word(30)}"),
        (2, f"{word(7)}, {word(2)} {passage} {word(41)}. {word(9)}."),
        (3, other),
        (4, "so " * 500),
        (5, f"{word(5)}. " + "so " * 300),
    ]
    out = dict(map(tuple, spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), removed_col="").collect()))
    assert out[1] == rows[0][1] and out[3] == other
    assert len(WORD.findall(out[2])) < 60 + 59 - 30
    assert len(WORD.findall(out[4])) <= 40 and len(WORD.findall(out[5])) <= 30


def test_passages_of_two_whole_sentences(spark):
    """Sixty shared words that begin and end inside sentences, with two whole ones of sixteen words between."""
    word = lambda n, k: " ".join(f"{k}{i}" for i in range(n))
    passage = f"{word(14, 'a')}. {word(16, 'b')}. {word(16, 'c')}. {word(14, 'd')}"
    rows = [(i, f"{word(2, f'x{i}')} {passage} {word(2, f'y{i}')}.") for i in (1, 2)]
    out = dict(map(tuple, spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), removed_col="").collect()))
    assert out[1] == rows[0][1] and not set(WORD.findall(out[2])) & set(word(16, "b").split() + word(16, "c").split())


def test_spans_on_odd_rows(spark, odd, none):
    out = spans.drop_repeated_spans(odd, removed_col="n_chars")
    assert out.columns == [*odd.columns, "n_chars_"]
    rows = out.collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in rows}
    source = {r.doc_id: r.text for r in odd.collect()}
    # The null id is first, so the others lose what they share with it.
    assert all(texts[i] == source[i] for i in (None, 3, 4, 5, 6, 7, 8, 9))
    assert len(texts[2] or "") < len(source[2]) and texts[10].startswith("Éa ñ.")
    assert spans.drop_repeated_spans(none).count() == 0


# 6. Vectors.


def test_topk_with_ties_repeats_and_bad_vectors(spark):
    r = np.random.default_rng(3)
    vectors = r.integers(-3, 4, (700, 6)).tolist() + [[2] * 6] * 300
    rows = list(enumerate(vectors)) + [(5, vectors[5]), (2000, [1, 2]), (2001, [2, 2])]
    table = spark.createDataFrame(rows, "id long, vector array<long>")
    queries = table.where("id % 50 = 0")
    got = sorted(map(tuple, knn.top_inner_products(table, queries, 20, shard=128, block=8).collect()))
    want = []
    for q, v in rows:
        if q % 50 == 0:
            best = sorted({(-int(np.dot(v, x)), i) for i, x in rows if i != q and len(x) == len(v)})[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert knn.top_inner_products(table.limit(0), queries.limit(0), 20).count() == 0


def test_topk_ignores_rows_without_an_id(spark):
    big = 2**53
    rows = [(big + 1, [1, 2]), (big + 3, [2, 1]), (None, [9, 9]), (None, [1, 1]), (40, [1, 1])]
    table = spark.createDataFrame(rows, "id long, vector array<long>")
    got = sorted(map(tuple, knn.top_inner_products(table, table.where("id is null or id = 40"), 20).collect()))
    assert got == [(40, 1, big + 1, 3), (40, 2, big + 3, 3)]


# 7. Quality.


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op7_quality"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (8, 1), (9, 0), (9, 0), (2, None), (10, 1), (10, 0), (None, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.keep_good(odd, model).columns == odd.columns
    for useless in (labels.limit(0), labels.where("quality = 1")):
        assert {r.score for r in quality.score(odd, quality.train(odd, useless)).collect()} == {0.5}
    assert quality.score(none, quality.train(none, labels)).count() == 0


def test_ratios_and_plane_match_plain_computations(spark):
    """Class counts of all labelled rows from Python sets, and the hinge loss of the plane against subgradient descent."""
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(["good", "fine", "well"] if i % 2 else ["bad", "poor", "so"]) if r.random() < 0.2 else f"w{r.randrange(30)}" for _ in range(12))) for i in range(120)]
    docs = spark.createDataFrame([*rows, (500, "no label")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    weights, bias = quality.train(docs, labels, features=1 << 12, epochs=200)
    sets = [set(quality.indicators(pa.array([t]), 1 << 12)[1].tolist()) for _, t in rows]
    count = [Counter(f for (i, _), own in zip(rows, sets, strict=True) if i % 2 == y for f in own) for y in (0, 1)]
    ratio = np.array([math.log((count[1][f] + 1) / 62) - math.log((count[0][f] + 1) / 62) for f in range(1 << 12)])
    assert weights[1] == pytest.approx(ratio**2)
    values = np.zeros((len(rows), 1 << 12))
    for i, own in enumerate(sets):
        values[i, list(own)] = ratio[list(own)]
    values = np.c_[values / np.linalg.norm(values, axis=1, keepdims=True), np.ones(len(rows))]
    y = np.array([1.0 if i % 2 else -1.0 for i, _ in rows])
    loss = lambda w: 0.5 * w @ w + quality.COST * np.maximum(0, 1 - y * (values @ w)).sum()
    scaled = np.divide(weights[0], ratio, out=np.zeros(1 << 12), where=ratio != 0)
    found, best, w = loss(np.r_[scaled, bias]), math.inf, np.zeros(values.shape[1])
    for step in range(1, 6000):
        w = w - (w - quality.COST * ((y * (values @ w) < 1) * y) @ values) / step
        best = min(best, loss(w))
    assert found <= best * 1.01


# 8. Similarity join.


def brute_groups(rows, k, percent):
    def shingles(text):
        w = words(text)
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[find(a)] = find(b)
    least = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            least[find(s)] = min(least.get(find(s), doc), doc)
    return Counter((d, len(s), least.get(find(s)) if s else d) for (d, _), s in zip(rows, sets, strict=True))


def grouped(docs, k, percent):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs, k=k, percent=percent).collect())


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(40)}"
    return " ".join(w)


@pytest.mark.parametrize(("frequent", "most"), [(jaccard.FREQUENT, 32), (3, 32), (3, 5)])
def test_groups_match_brute_force(spark, odd, monkeypatch, frequent, most):
    """Near copies with edits that partly coincide, with either class of shingles."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "MOST_IN_COMBINATIONS", most)
    base, long = prose(11, 90), prose(12, 400)
    rows = [(i, edited(base, i % 5, i)) for i in range(60)] + [(100 + i, edited(long, i, i)) for i in range(14)]
    rows += [(200 + i, "shared boilerplate words that many have in common here " + prose(50 + i, 12)) for i in range(20)]
    rows += [(300, "a b"), (301, "A b"), (302, "a c"), (303, None), (304, " "), (305, "a b c d e"), (306, "a b c d f")]
    rows += [(r.doc_id, r.text) for r in odd.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((4, 85), (5, 80)):
        assert grouped(docs, k, percent) == brute_groups(rows, k, percent)


def test_groups_of_an_empty_table(spark, none):
    assert grouped(none, 4, 85) == Counter()


# 9. WARC.


def test_warc_records_round_trip(spark):
    page = "<html><head><title>T&amp;t</title><style>x{}</style></head><body><!-- c --><p>A  b<br>c</p><script>var t='</p>'</script>é</body>"
    rows = [(1, "http://a/\r\nX: y", page), (1, "http://a/\r\nX: y", page), (2, None, None), (None, "", ""), (3, "u", "x\r\n\r\ny" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", urls.F.lit(1))
    records = warc.derivatives(warc.responses(pages))
    back = warc.read_back(records).collect()
    assert len(back) == 2 * len(rows)
    for r in back:
        assert r.headers["WARC-Block-Digest"] == warc.digest(bytes(r.block)) and int(r.headers["Content-Length"]) == len(r.block)
    conversions = {r.source: r for r in back if r.headers["WARC-Type"] == "conversion"}
    assert bytes(conversions[1].block).decode() == "T&t\nA b\nc\né"
    for r in back:
        if r.headers["WARC-Type"] == "metadata":
            fields = dict(x.split(": ", 1) for x in bytes(r.block).decode().split("\r\n") if x)
            twin = conversions[r.source]
            assert r.headers["WARC-Refers-To"] == twin.headers["WARC-Refers-To"]
            assert fields["conversion-record-id"] == twin.headers["WARC-Record-ID"]
            assert fields["conversion-block-digest"] == twin.headers["WARC-Block-Digest"]
    source = {i: h or "" for i, _, h in rows}
    assert any(warc.digest(source[1].encode()).encode() in bytes(r.block) for r in back)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        warc.parse_record(b"HTTP/1.1 200 OK\r\n\r\n")


def test_broken_markup_takes_linear_time_and_keeps_its_text():
    old = re.compile(r"<!--.*?-->|<(script|style|template|noscript)\b.*?</\1\s*>", re.S | re.I)
    r = random.Random(2)
    parts = ["<script>", "</script>", "</SCRIPT >", "<!--", "-->", "<style x>", "</style>", "<scripty>", "<p>", "a", "<", ">", "<a href='", "</p"]
    for _ in range(2000):
        page = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        assert warc.without_hidden(page) == old.sub(" ", page)
    for unit in ("<script>", "<!--", "<a", "</p", "<!", "<style><script>", "</script "):
        start = time.process_time()
        warc.plain_text(unit * (1_000_000 // len(unit)))
        assert time.process_time() - start < 3, unit


# 10. Mixing.


def brute_targets(sizes):
    """Sizes by source in order: share out by weight, stop at three times, share the rest again."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, budget = [0.0] * len(sizes), float(sum(sizes))
    open_ = set(range(len(sizes)))
    while open_:
        level = (budget - sum(target[i] for i in range(len(sizes)) if i not in open_)) / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * level > 3 * sizes[i] + 1e-9}
        for i in open_:
            target[i] = 3.0 * sizes[i] if i in over else weights[i] * level
        if not over:
            break
        open_ -= over
    return target


def test_mix_meets_targets(spark, odd, none):
    for docs in (documents(spark, "/root/testdata/sf0.01"), odd):
        got = mixing.schedule(docs).toPandas()
        got["source"] = got["source"].where(got["source"].notna(), "\U0010ffff")
        by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first")).sort_index()
        assert by.target.tolist() == pytest.approx(brute_targets(by["size"].tolist()))
        got["taken"] = got["size"] * got.finish.map(len)
        taken = got.groupby("source").taken.sum()
        largest = got.groupby("source")["size"].max()
        assert all(abs(taken[x] - by.target[x]) <= largest[x] / 2 + 1e-6 for x in by.index)
        assert got.finish.map(len).max() <= 3
    assert mixing.schedule(none).count() == mixing.mix(none).count() == 0


def test_mix_rows_are_ordered_and_agree(spark, odd):
    mixed = mixing.mix(odd)
    rows = mixed.collect()
    assert mixed.columns[: len(odd.columns)] == odd.columns and "size_" in mixed.columns
    assert [r.finish_ for r in rows] == sorted(r.finish_ for r in rows)
    plan = mixing.schedule(odd).collect()
    want = Counter()
    for r in plan:
        want[r.doc_id] += len(r.finish)
    assert Counter(r.doc_id for r in rows) == +want
    again = mixing.mix(odd.repartition(3)).collect()
    assert [r.doc_id for r in again] == [r.doc_id for r in rows]


# Pipeline.


def test_pipeline_by_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    for name, stage in corpus_pipeline.STAGES:
        out = shared.materialize(stage(spark, docs, sf), name)
        before, after = ({r.doc_id: r.text for r in x.collect()} for x in (docs, out))
        if name == "quality":
            bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
            good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
            assert len(bad & set(after)) <= 0.05 * len(bad) and len(good - set(after)) <= 0.02 * len(good)
        if name == "near_duplicates":
            want = brute_groups(sorted(before.items()), 5, 80)
            assert set(after) == {d for d, _, c in want if d == c}
        if name == "repeated_spans":
            kept = brute_spans(sorted(before.items()))
            assert {d: WORD.findall(t) for d, t in after.items()} == {d: w for d, w, n in kept if w or not n}
        if name == "mixing":
            assert set(after) <= set(before)
        else:
            assert out.columns == docs.columns
        docs = out
    first, again = (corpus_pipeline.run(spark, SF).collect() for _ in range(2))
    assert [(r.doc_id, r.repeat) for r in first] == [(r.doc_id, r.repeat) for r in again]
    assert first and [r.finish for r in first] == sorted(r.finish for r in first)


def test_stages_on_odd_rows(spark, odd, none):
    """Rows without an id, repeated rows, empty texts and clashing columns; each stage on rows it has kept."""
    base, other = prose(70, 80), prose(71, 80)
    rows = [(3, base), (3, base), (None, base), (7, base + " end"), (None, other), (8, None), (8, ""), (9, ""), (None, None), (4, other), (4, "something else here")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOC).withColumns({"_kept_id": jaccard.F.lit(1), "_copies": jaccard.F.lit("x")})
    out = corpus_pipeline._near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(3, base), (4, other), (8, None), (8, ""), (9, ""), (None, None), (4, "something else here")], key=repr)
    cut = corpus_pipeline._repeated_spans(spark, out, SF)
    assert cut.columns == docs.columns and sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == got
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).columns[: len(odd.columns)] == odd.columns
        assert stage(spark, none, SF).count() == 0, name


def test_stages_leave_few_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_root", lambda _spark: str(tmp_path))
    out = corpus_pipeline.run(spark, SF)
    assert [p.name for p in tmp_path.glob("placelens-*/*")] == ["mixing"] and out.count()
