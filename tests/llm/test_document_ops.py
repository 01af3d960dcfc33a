"""The operators on documents against brute force, with nulls, empty texts, repeated rows and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from salesmart.llm import decontamination, line_dedup, minhash_dedup, mixing, suffix_dedup
from salesmart.llm._components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, label int, window_id long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    shared = "A line that Many documents share, word for word, number 42"
    texts = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if i % 4 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        lines = [" ".join(words)]
        if i % 3 == 0:
            lines.insert(0, " \t" + (shared.upper() if i % 2 else shared) + "\r")
        if i % 9 == 0:
            lines.append(shared)
        texts.append("\n".join(lines))
    texts += [texts[4], texts[4] + " tail", texts[8].replace("a", "A", 3), "", None, "short", "x" * 500, "ab" * 300, "\n\n"]
    rows = [(i, t, "en", "s1", 1, "x", 0, 7) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[5], (None, texts[4], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(rows):
    return {r[0]: (r[1] or "") for r in rows if r[0] is not None}


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_lines(rows, docs):
    texts, where = by_id(rows), {}
    for doc, text in texts.items():
        for line in text.split("\n"):
            where.setdefault(line_key(line), set()).add(doc)
    gone = {k: max(d) for k, d in where.items() if len(k) >= 40 and len(d) >= 5}
    assert gone
    got = line_dedup.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_dropped"] == 0
            continue
        lines = texts[r["doc_id"]].split("\n")
        kept = [x for x in lines if gone.get(line_key(x), r["doc_id"]) == r["doc_id"]]
        assert (r["n_lines"], r["n_dropped"], r["text"] or "") == (len(lines), len(lines) - len(kept), "\n".join(kept))
        assert r["bucket"] == "x"


def test_one_line_over_many_ranges(spark):
    line = "the same very long line that every single document of this table holds"
    table = spark.createDataFrame([(i, f"{line}\n{i}") for i in range(3000)], "doc_id long, text string").repartition(7)
    got = line_dedup.dedup_lines(table).where("n_dropped = 0").collect()
    assert [r["doc_id"] for r in got] == [2999]


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    texts = []
    for i in range(80):  # copies of copies, so that links form chains and stars
        words = list(base if i % 3 else texts[-1].split() if texts else base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts += ["", None, "one two", "One TWO", "one two three"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    sets = {d: shingles(t or "", 4) for d, t in rows}
    label = {d: d for d in sets}
    while True:
        before = dict(label)
        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    assert len(set(label.values())) < len(label)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4, percent=80).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), label[r["doc_id"]], label[r["doc_id"]] == r["doc_id"])


def test_keep_one_and_empty_tables(spark, rows, docs):
    kept = minhash_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 4 in ids and 60 not in ids
    none = docs.limit(0)
    assert minhash_dedup.near_duplicates(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert suffix_dedup.dedup_substrings(none).count() == 0
    assert decontamination.contamination(none, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert mixing.mix_documents(none).count() == 0


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, 400)], rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
        bins = minhash_dedup.parity(a) ^ minhash_dedup.parity(b)
        assert sum(int(x).bit_count() for x in bins.view(np.uint64)) <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(200, 150), (150, 170), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and {got[i] for i in (150, 170, 200)} == {150}


def test_contamination(spark, rows, docs):
    words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    texts = by_id(rows)
    items = [(1, texts[4]), (10, " ".join(words_of(texts[8])[:12])), (2, "short"), (3, "a b c d e f g h i j k l"), (4, None), (5, "!!"), (None, "short"), (6, texts[4])]
    windows = []
    for item, text in items:
        w = words_of(text)
        if item is not None:
            windows += [(str(item), w[i : i + min(10, len(w))]) for i in range(max(0, len(w) - min(10, len(w)) + 1)) if w]
    bench = spark.createDataFrame(items, "item_id long, text string")
    old = decontamination.PASS_WINDOWS
    for passes in (old, 7):
        decontamination.PASS_WINDOWS = passes
        try:
            got = decontamination.contamination(docs, bench).where("doc_id IS NOT NULL").collect()
        finally:
            decontamination.PASS_WINDOWS = old
        assert len(got) == len(texts)
        for r in got:
            w, hit, named = words_of(texts[r["doc_id"]]), set(), set()
            for item, window in windows:
                for i in range(len(w) - len(window) + 1):
                    if w[i : i + len(window)] == window:
                        hit.update(range(i, i + len(window)))
                        named.add(item)
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(named))
    empty = decontamination.contamination(docs, bench.limit(0))
    assert empty.where("n_hit > 0").count() == 0 and empty.where("doc_id IS NOT NULL").count() == len(texts)


def test_substrings(rows, docs):
    texts, seen, expected = by_id(rows), set(), {}
    for doc in sorted(texts):
        body = texts[doc].encode()
        gone = bytearray(len(body))
        for s in range(len(body) - 99):
            if body[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(body[s : s + 100])
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        expected[doc] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert sum(e[1] for e in expected.values()) > 0
    got = suffix_dedup.dedup_substrings(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) == expected[r["doc_id"]]


def test_merge_of_front_coded_runs():
    rng = random.Random(2)
    parts = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 30))) for _ in range(5)]
    runs, base, flat = [], 0, []
    for part in parts:
        shared, rest = suffix_dedup.front_coded(part)
        runs.append(suffix_dedup._Run(shared, np.array([len(x) for x in part]), rest, base))
        base += len(part)
        flat += part
    order, prefixes = suffix_dedup.merge_runs(runs)
    merged = [flat[i] for i in order]
    assert merged == sorted(flat)
    assert prefixes[1:] == [suffix_dedup.common_prefix(a, b) for a, b in zip(merged, merged[1:], strict=False)]


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", "de", None]), f"src{rng.randint(0, 6)}", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    old = mixing.ROWS_PER_BUCKET
    mixing.ROWS_PER_BUCKET = 5
    try:
        got = mixing.mix_documents(docs).collect()
    finally:
        mixing.ROWS_PER_BUCKET = old
    total = sum(len(r[1].split()) for r in rows)
    used = sum(r["n_tokens"] for r in got)
    assert 0.5 * total - 30 * 30 <= used <= 0.5 * total
    leaves, epochs = {}, {}
    for r in got:
        leaf = (r["l0"], r["l1"], r["l2"])
        leaves[leaf] = leaves.get(leaf, 0) + r["n_tokens"]
        assert (r["doc_id"], r["epoch"]) not in epochs
        epochs[r["doc_id"], r["epoch"]] = leaf
    size = {}
    for r in rows:
        leaf = (f"domain{int(r[3][3:]) % 4}", r[2] or "none", r[3])
        size[leaf] = size.get(leaf, 0) + len(r[1].split())
    assert all(leaves[x] <= 3 * size[x] for x in leaves)


def leaf_prefix(rows, budget, seed_of):
    """Turns of each row: whole epochs, then the longest prefix in the seeded order; equal rows are interchangeable."""
    total = sum(len((r[1] or "").split()) for r in rows)
    whole, rest = (budget // total, budget % total) if total else (0, 0)
    turns, left, open_ = {}, rest, True
    for r in sorted(rows, key=lambda r: seed_of[r, whole]):
        n = len((r[1] or "").split())
        open_ = open_ and n <= left
        if open_:
            left -= n
        turns[r] = turns.get(r, 0) + whole + int(open_)
    return {r: t for r, t in turns.items() if t}


def test_chosen_rows_are_the_longest_prefix(spark):
    """Twins and rows without id, against brute force over the same seeded order."""
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 2, 3, 4]), "w " * rng.choice([0, 3, 10, 10]), rng.choice("ab"), "clash", 1) for _ in range(120)]
    rows += [(None, "one two three", "a", "clash", 1)] * 30 + [(7, "w " * 25_000, "c", "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `__key` string, n_last int").repartition(4)
    order = {}
    for whole in range(4):
        keyed = docs.distinct().withColumn("at", F.xxhash64(F.lit(17), F.lit(whole), "doc_id", F.xxhash64("text"))).collect()
        for r in keyed:
            order[tuple(r)[:5], whole] = (r["at"], r["doc_id"] is not None, r["doc_id"] or 0)
    old = mixing.ROWS_PER_BUCKET
    for share, size in ((0.05, 7), (0.7, 7), (1.9, 10_000)):
        mixing.ROWS_PER_BUCKET = size
        try:
            got = mixing.mix(docs, [F.col("source")], [{"a": 3.0}], share=share)
            assert got.columns == [*docs.columns, "l0", "n_tokens", "epoch"]
            found = got.collect()
        finally:
            mixing.ROWS_PER_BUCKET = old
        leaves = {}
        for r in rows:
            leaves.setdefault(r[2], []).append(r)
        table = spark.createDataFrame([(k, sum(len(r[1].split()) for r in v)) for k, v in leaves.items()], "l0 string, tokens long")
        budgets = {r["l0"]: r["budget"] for r in mixing.leaf_budgets(table, 1, [{"a": 3.0}], share, 3).collect()}
        for leaf, members in leaves.items():
            mine = [r for r in found if r["l0"] == leaf]
            assert sum(r["n_tokens"] for r in mine) <= budgets[leaf]
            turns = {}
            for r in mine:
                turns[tuple(r)[:5]] = turns.get(tuple(r)[:5], 0) + 1
            assert turns == leaf_prefix(members, budgets[leaf], order), (share, leaf)


def test_twins_never_exceed_the_budget(spark):
    for rows, share, given in (([(1, "a b c d e f g h i j")] * 2, 0.5, 10), ([(None, "a b c d e f g h i j")] * 10, 0.5, 50), ([(None, "")] * 3, 0.5, 0)):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = mixing.mix(docs, [F.lit("x")], [{}], share=share).collect()
        assert sum(r["n_tokens"] for r in got) == given


def test_budgets_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000)], "l0 string, l1 string, tokens long")
    got = {(r["l0"], r["l1"]): r["budget"] for r in mixing.leaf_budgets(leaves, 2, [{}, {}], 0.5, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 492, ("b", "z"): 502}
