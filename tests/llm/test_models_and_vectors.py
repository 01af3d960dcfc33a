"""Search, language model, token counts and classifiers against brute force or held-out accuracy."""

import math
import random

import duckdb
import numpy as np
import pytest

from salesmart.llm import queries as llm
from salesmart.llm import context_tree, cotraining, kd_search, token_edits, toxicity
from salesmart.llm._shared import SPACED, shingle_hashes, word_hashes


@pytest.mark.parametrize("spread", [1.0, 1e5])
def test_search(spark, spread):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6) * spread]) for i in range(0, 600, 3)]
    vectors += [(i, [0.5, 0.25, -0.5, 1.0, 0.0, 0.125]) for i in range(1000, 1400)]
    vectors += [(2000, None), (2100, []), (2200, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2300, [float("nan")] * 6), (2400, [float("inf")] * 6), (None, [1.0] * 6), (2500, [1.0, 2.0]), (2501, [2.0, 2.0]), ]
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    expected = set()
    for q, a in whole.items():
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), v) for v, b in whole.items() if v != q and len(a) == len(b))[:10]
            expected |= {(q, r + 1, v, -s) for r, (s, v) in enumerate(scored)}
    old = kd_search.SHARD_ROWS, kd_search.LEAF_ROWS
    kd_search.SHARD_ROWS = 100
    try:
        table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
        assert {tuple(r) for r in kd_search.top_k(table).collect()} == expected
    finally:
        kd_search.SHARD_ROWS = old[0]
    assert kd_search.top_k(table.limit(0)).count() == 0


def test_repeated_ids_equal_rows_and_huge_components(spark):
    """Against the registered oracle, which counts every row; vectors whose scores fit no long are left out."""
    rng = np.random.default_rng(5)
    rows = [(100, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [5.0, 0.0]), (100, [3.0, 1.0]), (200, [1.0, 1.0]), (100, [1.0, 0.0])]
    rows += [(7, [4.0, 0.0])] * 40 + [(int(rng.integers(0, 60)), [float(x) for x in rng.normal(size=2)]) for _ in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    connection = duckdb.connect()
    connection.register("embeddings", table.toArrow())
    result = connection.execute(llm.ORACLE["op1_kd_search"])
    names = [d[0] for d in result.description]
    got = kd_search.top_k(table).select(*names).collect()
    assert sorted(tuple(r) for r in got) == sorted(result.fetchall())
    huge = table.union(spark.createDataFrame([(300, [1e200, 1.0]), (301, [1e308, 1.0]), (302, [2.0**40, 0.0])], table.schema))
    assert sorted(tuple(r) for r in kd_search.top_k(huge).select(*names).collect()) == sorted(tuple(r) for r in got)


def test_tree_opens_few_leaves():
    rng = np.random.default_rng(0)
    points = np.floor(rng.normal(size=(4000, 3)) * 1024)
    tree = kd_search.KdTree(np.arange(4000), points)
    best = tree.search(points[:5], np.arange(5), np.full(5, -np.inf), 10)
    for i, found in enumerate(best):
        scores = points @ points[i]
        scores[i] = -np.inf
        assert sorted(s for s, _ in found) == sorted(np.sort(scores)[-10:].astype(int).tolist())


def texts(n=60):
    rng = random.Random(3)
    parts = ["ba", "na", "ko", "té", "ri", "lu"]
    return [" ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_context_tree_is_a_distribution_and_weights_depths():
    bodies = [np.frombuffer(t.encode(), np.uint8) for t in texts()]
    for bits in (8, 2, 0):
        keys, n = np.unique(np.concatenate([context_tree.pair_keys(b, bits) for b in bodies]), return_counts=True)
        tree = context_tree.ContextTree(keys, n.astype(float), bits)
        for context in ("bana ", "zzzzz", "té"):
            body = np.frombuffer(context.encode(), np.uint8)
            key = context_tree.pair_keys(body, bits)[-1] & ~np.uint64(0xFF)
            assert abs(sum(10 ** tree.log10(np.array([key | np.uint64(b)], np.uint64))[0] for b in range(256)) - 1) < 1e-5
        fresh = np.frombuffer("bana kolu tériba".encode(), np.uint8)
        assert tree.score(fresh) > -len(fresh) * math.log10(256) / 3


def test_scores_stay_finite_after_very_many_equal_bytes():
    body = np.frombuffer(b"aaaaaaaa", np.uint8)
    keys, n = np.unique(context_tree.pair_keys(body), return_counts=True)
    tree = context_tree.ContextTree(keys, n * 1e9, 8)
    assert math.isfinite(tree.score(np.frombuffer("aaaaaaaaé".encode(), np.uint8)))


def test_kt_estimate():
    zeros, ones = np.array([0, 1, 2, 50, 9000]), np.array([0, 0, 3, 20, 4])
    for a, b, got in zip(zeros, ones, context_tree._kt(zeros, ones), strict=True):
        assert abs(got - (math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi))) < 1e-9


def test_long_texts_in_blocks(monkeypatch):
    body = np.frombuffer((" ".join(texts()) * 3).encode(), np.uint8)
    keys, n = np.unique(context_tree.pair_keys(body), return_counts=True)
    tree, whole = context_tree.ContextTree(keys, n.astype(float), 8), word_hashes(body, SPACED)
    score = tree.score(body)
    monkeypatch.setattr(context_tree, "BLOCK", 97)
    monkeypatch.setattr("salesmart.llm._shared.BLOCK", 97)
    assert abs(tree.score(body) - score) < 1e-6
    assert (word_hashes(body, SPACED) == whole).all()
    assert len(set(shingle_hashes(whole, 3).tolist())) == len({tuple(whole[i : i + 3].tolist()) for i in range(len(whole) - 2)})


def test_scores_of_texts(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "FREQUENT", 5)
    rows = [(i, t) for i, t in enumerate([*texts(), "", None, "NEW unseen Words", "ba ba BA"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = docs.where("doc_id % 3 != 0")
    counts: dict = {}
    for i, t in rows:
        if i % 3:
            for w in [*(t or "").lower().split(), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in context_tree.score_texts(docs, training).collect():
        words = [*(rows[r["doc_id"]][1] or "").lower().split(), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), n)
        assert abs(r["base_score"] - base) < 1e-6 and r["score"] < 0
    bare = context_tree.score_texts(docs, docs.limit(0)).where("doc_id = 3").first()
    assert bare["n_known"] == 0 and bare["base_score"] == 0


@pytest.mark.parametrize("unit", [5_000, 8 << 20])
def test_sharded_tree_equals_whole_tree(spark, monkeypatch, unit):
    rng = random.Random(8)
    if unit < 10_000:
        monkeypatch.setattr(context_tree, "UNIT_BYTES", unit)
        monkeypatch.setattr(context_tree, "SHARD_BYTES", 700)
        rows = [(i, t) for i, t in enumerate([*texts(200), "", None, "zz! never met %", "ba " * 4000])]
    else:  # over 700,000 distinct pairs
        rows = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789 .,;:-+()[]{}<>/=_&%$!?", k=9000))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    training = docs.where("doc_id % 9 != 0")
    body = lambda t: np.frombuffer((t or "").encode(), np.uint8)
    keys, n = np.unique(np.concatenate([context_tree.pair_keys(body(t)) for i, t in rows if i % 9]), return_counts=True)
    assert unit < 10_000 or len(keys) > 700_000
    tree = context_tree.ContextTree(keys, n.astype(float), 8)
    got = {r["doc_id"]: r["score"] for r in context_tree.score_texts(docs, training).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i] - tree.score(body(t))) < 1e-4 * (1 + len(t or ""))**0.5


def test_edits():
    rng = random.Random(9)
    counter = token_edits.Counter(token_edits.VOCABULARY)
    alphabet = ["word", " ", "  ", "\n", "'s", "12", "!", "é", "it", "a"]
    for _ in range(150):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400)))
        tree = token_edits.TokenTree(text, counter)
        for _ in range(6):
            at, length = rng.randint(0, len(text) + 2), rng.choice([0, 1, 5, 200])
            put = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 90])))
            tree.edit(at, length, put)
            text = text[:at] + put + text[at + length :]
            assert tree.text == text
            assert [x for leaf in tree.leaves for x in leaf] == [(len(p), counter.of(p)) for p in counter.pattern.findall(text)]
            assert tree.n_tokens == len(counter.encode(text))


def test_batches_of_edits_on_stored_trees(spark):
    """Two batches: each loads only its own texts, encodes little, and gives what encoding the whole texts anew gives."""
    rng = random.Random(11)
    encode = token_edits.Counter(token_edits.VOCABULARY).encode
    rows = [(i, t) for i, t in enumerate([*texts(30), "", None, "ba " * 20_000])] + [(3, "another ba na"), (None, "ba"), (5, texts(30)[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trees = token_edits.build_trees(docs)
    for batch in range(2):
        table = {(r["doc_id"], r["text_key"]): r for r in trees.collect()}
        assert sum(1 for _ in trees.collect()) == len(rows)
        for r in table.values():
            assert r["n_tokens"] == sum(r["tokens"]) == len(encode(r["text"])) and sum(r["lengths"]) == len(r["text"])
        chosen = [k for k in sorted(table, key=repr) if k[0] is not None and k[0] % 3 == batch] + ([(32, k[1]) for k in table if k[0] == 32] if batch else [])
        plans = {}
        for k in dict.fromkeys(chosen):
            size, places = len(table[k]["text"]), []
            for start in sorted(rng.sample(range(size + 1), min(size + 1, 3))):
                if not places or start >= places[-1][0] + places[-1][1]:
                    places.append((start, rng.randint(0, 4), rng.choice(["", "x y", " na\n", "'s"])))
            plans[k] = places
        edits = spark.createDataFrame([(*k, p) for k, p in plans.items()] + [(999, 1, [(0, 1, "x")])], f"doc_id long, text_key long, edits {token_edits.EDITS}")
        edited = token_edits.apply_edits(trees, edits)
        got = edited.collect()
        assert {(r["doc_id"], r["text_key"]) for r in got} == set(plans)
        for r in got:
            text = table[r["doc_id"], r["text_key"]]["text"]
            for start, length, new in reversed(plans[r["doc_id"], r["text_key"]]):
                text = text[:start] + new + text[start + length :]
            assert r["text"] == text and r["n_after"] == len(encode(text)) and r["n_encoded"] <= 40
        trees = spark.createDataFrame(token_edits.edited_trees(trees, edited).toArrow())


def test_edits_of_a_table(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, ""), (4, "of%%% signs!!")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_edits.recount(token_edits.with_cleaning_edits(docs)).collect()}
    encode = token_edits.Counter(token_edits.VOCABULARY).encode
    assert got[4]["n_after"] == len(encode("of signs\n")) and got[2]["n_tokens"] == 0 and got[3]["n_after"] == 1


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    bad = ["idiot", "moron", "scum"]
    disguised = ["1d1ot", "m0r0n", "i d i o t", "idioooot", "s.c.u.m"]
    rows = []
    for i in range(600):
        words = texts(1)[0].split() or ["ba"]
        rng.shuffle(words)
        toxic = i % 4 == 0
        if toxic:
            words.insert(0, rng.choice(bad if i % 8 else disguised + bad))
        junk = i % 5 == 0
        rows.append((i, " ".join(w + "%%%" if junk else w for w in words), "en" if i % 2 else None, f"src{i % 7}", 9 if junk else 900, int(toxic), int(not junk)))
    rows.append((600, "", None, None, None, 0, 1))
    rows.append((601, None, None, None, None, None, None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, toxic int, quality int")


def test_toxicity(spark, labelled):
    docs, labels = labelled.select("doc_id", "text", "lang"), labelled.select("doc_id", "toxic")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    wrong = [d for d, t in truth.items() if t is not None and (got[d] >= 0.5) != bool(t)]
    assert len(wrong) <= 6 and len(got) == 602 and 0 <= got[601] < 0.5
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


def test_restoring_words(labelled):
    model = toxicity.character_model(labelled.select("doc_id", "text"))
    restorer = toxicity.Restorer(model)
    assert restorer.word("1d1ot") == "idiot" and restorer.word("m0r0n,") == "moron"
    assert restorer.word("s.c.u.m") == "scum" and restorer.spaced("an i d i o t here") == ["idiot"]
    assert restorer.word("plain") == "plain" and restorer.word("2024") == "2024"


def test_disguises_at_edges_doubled_and_spaced(labelled):
    restorer = toxicity.Restorer(toxicity.character_model(labelled.select("doc_id", "text")))
    for token, plain in [("!diot", "idiot"), ("|diot", "idiot"), ("!diot!", "idiot"), ("id!ot!", "idiot"), ("1d10t", "idiot"), ("1d10+", "idiot"), ("sccum", "scum"), ("moorron", "moron"), ("scum$$", "scum"), ("plain", "plain"), ("2024", "2024")]:
        assert plain in restorer.readings(token), (token, restorer.readings(token))
    for text in ["m o r o n!", "m o r o n, x", "(m o r o n)", "m  o  r  o  n", "m\no\nr\no\nn", "a m o r o n", "m o r o n", "what m o r o n !"]:
        assert "moron" in restorer.spaced_readings(text), (text, restorer.spaced_readings(text))
    assert "ass" in {r[:3] for r in restorer.readings("a$$")}


def test_cotraining(labelled):
    docs, labels = labelled.drop("toxic", "quality"), labelled.select("doc_id", "quality").where("doc_id % 3 = 0")
    got = {r["doc_id"]: r["score"] for r in cotraining.score(docs, cotraining.train(docs, labels)).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labelled.collect() if r["quality"] is not None}
    assert sum((got[d] >= 0.5) == bool(t) for d, t in truth.items()) >= 0.97 * len(truth) and len(got) == 602
    assert {r["score"] for r in cotraining.score(docs, cotraining.train(docs, labels.limit(0))).collect()} == {0.5}


def test_whole_pool_teaches(spark, labelled, monkeypatch):
    docs, labels = labelled.drop("toxic", "quality"), labelled.select("doc_id", "quality").where("doc_id % 3 = 0")
    far = spark.range(10_000, 30_000).selectExpr("id AS doc_id", "'ba na ko' AS text", "'xx' AS lang", "'new' AS source", "9L AS n_chars")
    taught, seen = cotraining._taught_by, []

    def watched(pool):
        seen.append(pool.count())
        step = taught(pool)

        def sums(teach, learn):
            out = step(teach, learn)
            rows = pool.toArrow().combine_chunks().to_batches()
            x = [np.concatenate(c) for c in zip(*map(cotraining._dense, rows), strict=True)]
            for v in (0, 1):
                p = 1 / (1 + np.exp(-(x[1 - v] @ teach[1 - v])))
                sure = np.maximum(p, 1 - p) >= cotraining.CONFIDENT
                q = 1 / (1 + np.exp(-np.clip(x[v][sure] @ learn[v], -30, 30)))
                assert out[v][0] == sure.sum() and np.allclose(out[v][1], x[v][sure].T @ (q - (p[sure] >= 0.5)))
            return out

        return sums

    monkeypatch.setattr(cotraining, "_taught_by", watched)
    monkeypatch.setattr(cotraining, "ROUNDS", 1)
    cotraining.train(docs.unionByName(far), labels)
    assert seen[0] > 8_000 and seen[0] == docs.unionByName(far).where("doc_id % 3 != 0 OR doc_id > 600").where("crc32(cast(string(doc_id) AS binary)) % 5 != 0").count()
