"""Byte-level BPE, periodic runs and the Merkle manifest against brute force and the tokenizer library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from salesmart.llm import byte_bpe, merkle_manifest, periodic_runs
from salesmart.llm import queries as llm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, runs int, position long, tree string"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc(doc):
    return zlib.crc32(str(doc).encode())


def corpus(n=140, seed=4):
    rng = random.Random(seed)
    vocabulary = ["the", "don't", "we're", "x1", "42", "naïve", "中文", "😀", "!!", "'s", "Ünder", "A", "b", "c"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary[: rng.randint(1, 14)]) for _ in range(rng.randint(0, 60))]
        if i % 7 == 0:
            words += words[-5:] * 3
        gap = rng.choice([" ", "  ", "\n", "\t ", "　"])
        rows.append((i, gap.join(words), rng.choice(["en", "en", "de", "é", None]), rng.choice(["s1", None]), rng.choice([None, len(words)])))
    rows += [(n + 4, "a b " * 9 + "x y z " + "c d e " * 6, "en", "s", 1), (n, "", "en", "s", 0), (n + 1, None, "en", None, None), (n + 2, " \n ", "only", "s", 3), (n + 3, "q" * 70_000 + " ab" * 9_000, "de", "s", 1)]
    rows += [rows[3], rows[3], (3, "another text of this id", "en", "s", 1), (None, "A b A b", None, None, None), (None, None, "en", None, None)]
    return [(*r, "x", 1, 2, "y") for r in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{path}/empty/documents.parquet")
    return path


def same_rows(got, expected):
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, expected))


# --- byte-level BPE ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.VOCABULARY, "rb") as lines:
        merger = byte_bpe.Merger(lines.read())
    return merger, tiktoken.Encoding("all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merger.ranks, special_tokens={})


def test_pretokens_and_merges_in_blocks(library, monkeypatch):
    merger, encoding = library
    rng, classes = random.Random(3), byte_bpe.code_point_classes()
    pieces = ["'", "s", "re", "ve", "v", " ", "  ", "\n", "\t", "\xa0", "\x85", "\x1c", "é", "1", "²", "!", "中", "😀", "ll", "d", "'t", "A", "́"]
    for _ in range(200):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(5)]
        body = np.frombuffer("".join(texts).encode(), np.uint8)
        ends = np.cumsum([0, *(len(t.encode()) for t in texts)])
        monkeypatch.setattr(byte_bpe, "SCAN", rng.choice([1, 7, 1 << 20]))
        starts = byte_bpe.pretoken_starts(body, ends[:-1][ends[1:] > ends[:-1]], classes)
        assert merger.ids(memoryview(body), starts).tolist() == [i for t in texts for i in encoding.encode_ordinary(t)]


def test_scan_equals_steps_in_order():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 5000):
        symbols = rng.integers(0, 8, n)
        state, expected = byte_bpe._FRESH, []
        for x in symbols:
            state = int(byte_bpe._NEXT[state, x])
            expected.append(state)
        assert byte_bpe._FUNCTIONS[byte_bpe.scan(byte_bpe._INSIDE[symbols]), byte_bpe._FRESH].tolist() == expected


def test_every_code_point_as_the_library_splits_it(library):
    merger, encoding = library
    points = [c for c in [*range(0x3000), *range(0x1F000, 0x1FC00), 0xE0041, 0xF0000, 0x10FFFF] if not 0xD800 <= c < 0xE000]
    text = "".join(f"{chr(c)}A {chr(c)}1{chr(c)}!\n" for c in points)
    body = np.frombuffer(text.encode(), np.uint8)
    starts = byte_bpe.pretoken_starts(body, np.array([0]), byte_bpe.code_point_classes())
    assert merger.ids(memoryview(body), starts).tolist() == encoding.encode_ordinary(text)


def test_tokens_of_a_table(spark, rows, docs, library):
    encoding = library[1]
    got = byte_bpe.encode(docs).collect()
    same_rows([(r["doc_id"], r["ids"]) for r in got], [(r[0], encoding.encode_ordinary(r[1] or "")) for r in rows])
    parts = encoding.decode_tokens_bytes
    for r in got:
        assert r["offsets"] == np.cumsum([0, *map(len, parts(r["ids"]))])[:-1].tolist()
    again = byte_bpe.decode(byte_bpe.encode(docs)).select("doc_id", "decoded").collect()
    same_rows([(r["doc_id"], bytes(r["decoded"])) for r in again], [(r[0], (r[1] or "").encode()) for r in rows])


def test_a_slice_of_tokens_decodes_and_wrong_offsets_fail(docs):
    tokens = byte_bpe.encode(docs.where("doc_id = 5"))
    whole = byte_bpe.decode(tokens).first()
    cut = tokens.withColumn("ids", F.slice("ids", 3, 4)).withColumn("offsets", F.slice("offsets", 3, 4))
    at = whole["offsets"]
    assert bytes(byte_bpe.decode(cut).first()["decoded"]) == bytes(whole["decoded"])[at[2] : at[6]]
    with pytest.raises(Exception, match="offsets"):
        byte_bpe.decode(tokens.withColumn("offsets", F.transform("offsets", lambda x: x * 2))).collect()


def test_bpe_query(spark, folder, rows, library):
    expected = []
    for r in rows:
        ids = library[1].encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(r[1] or "")))
    same_rows(llm.op11_byte_bpe(spark, folder).collect(), expected)
    assert llm.op11_byte_bpe(spark, f"{folder}/empty").count() == 0


# --- periodic runs -------------------------------------------------------------------------------------------------------


def brute_runs(words, min_length):
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            if length >= max(min_length, 2 * q) and all(any(part[k] != part[k + d] for k in range(length - d)) for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


@pytest.mark.parametrize("min_length", [2, 5, 12])
def test_runs_against_all_periods(min_length):
    rng = random.Random(min_length)
    for _ in range(400):
        letters = "abcdefghijkl"[: rng.randint(1, 6)]
        words = [rng.choice(letters) for _ in range(rng.randint(0, 50))]
        if words and rng.random() < 0.5:
            a, p = rng.randrange(len(words)), rng.randint(1, 9)
            words = [w if i < a or a + (i - a) % p >= len(words) else words[a + (i - a) % p] for i, w in enumerate(words)]
        if rng.random() < 0.3:
            words = words + [f"z{k}" for k in range(5)] + words
        found, _, _ = periodic_runs.document_runs(np.frombuffer(" ".join(words).encode(), np.uint8), min_length)
        assert [tuple(x) for x in found.tolist()] == brute_runs(words, min_length)


def test_extensions_against_comparison():
    rng = random.Random(2)
    for _ in range(30):
        symbols = [rng.randint(1, 3) for _ in range(rng.randint(2, 200))]
        tree = periodic_runs.SuffixTree([*symbols, 0], 4)
        assert tree.ranks().tolist() == np.argsort(np.array(sorted(range(len(symbols) + 1), key=lambda i: [*symbols, 0][i:]))).tolist()
        pairs = np.array([(i, j) for i in range(len(symbols)) for j in range(i + 1, len(symbols) + 1)])
        lengths = tree.extensions().of(pairs[:, 0], pairs[:, 1])
        for (i, j), n in zip(pairs.tolist(), lengths.tolist(), strict=True):
            assert symbols[i : i + n] == symbols[j : j + n] and (j + n == len(symbols) or symbols[i + n] != symbols[j + n])


def planted_words(doc, text):
    words = (text or "").encode().split()
    if doc is None or crc(doc) % 10 or not words:
        return words
    n, g = len(words), crc(doc) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark, folder, rows):
    expected = []
    for r in rows:
        words = planted_words(r[0], r[1])
        if len(words) > 2000:
            runs, _, _ = periodic_runs.document_runs(np.frombuffer(b" ".join(words), np.uint8))
            runs = [tuple(x) for x in runs.tolist()]
            assert (0 if not crc(r[0]) % 10 else 1, 9000, 1) in runs or not crc(r[0]) % 10
        else:
            runs = brute_runs(words, 12)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        head = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((r[0], len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept)))
    assert any(e[1] > 1 for e in expected)
    same_rows(llm.op12_periodic_runs(spark, folder).collect(), expected)
    assert llm.op12_periodic_runs(spark, f"{folder}/empty").count() == 0


# --- Merkle manifest -----------------------------------------------------------------------------------------------------


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf_of(doc, source, lang, n_chars, text):
    return sha("".join(map(field, (doc, source, lang, n_chars, text))))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, at):
    siblings, groups = [], []
    for level in levels[:-1]:
        group = list(range(at // 8 * 8, min(len(level), at // 8 * 8 + 8)))
        siblings += [level[i] for i in group if i != at]
        groups.append(([level[i] for i in group], at % 8))
        at //= 8
    return siblings, groups


def brute_manifest(rows):
    trees = {}
    for r in rows:
        doc, text, lang, source, n_chars = r[:5]
        low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        struck = doc is not None and crc(doc) % 3 == 0
        leaf = leaf_of(doc, source, lang, n_chars, text)
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, doc, leaf_of(doc, source, lang, n_chars, low) if struck else leaf))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for members in trees.values():
        members.sort(key=lambda m: m[:3])
    levels = {lang: levels_of([m[2] for m in trees[lang]]) for lang in langs}
    top = levels_of([levels[lang][-1][0] for lang in langs])
    out = []
    for t, lang in enumerate(langs):
        for i, (_, _, leaf, doc, shown) in enumerate(trees[lang]):
            siblings, groups = path_of(levels[lang], i)
            more, above = path_of(top, t)
            digest = shown
            for group, place in groups + above:
                digest = sha("".join([*group[:place], digest, *group[place + 1 :]]))
            root = top[-1][0]
            out.append((doc, leaf, levels[lang][-1][0], root, sha("".join(siblings + more)), digest, digest == root))
    return out


def test_manifest_query(spark, folder, rows):
    expected = brute_manifest(rows)
    assert {e[-1] for e in expected} == {True, False}
    same_rows(llm.op13_merkle_manifest(spark, folder).collect(), expected)
    assert llm.op13_merkle_manifest(spark, f"{folder}/empty").count() == 0


def test_more_languages_than_one_group_and_single_proofs(spark):
    rows = [(i, f"Text {i}", f"l{i % 10 if i < 90 else 3:02d}" if i % 31 else None, "s", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle_manifest.build(docs, levels=1)
    expected = {e[0]: e for e in brute_manifest(rows)}
    assert manifest.root == expected[0][3]
    some = merkle_manifest.prove(manifest, manifest.leaves.where("row_id % 90 = 7"))
    got = merkle_manifest.verify(some.withColumn("proof", F.sha2("siblings", 256))).collect()
    assert len(got) == 10
    for r in got:
        assert (r["leaf"], r["subroot"], r["root"], r["proof"]) == expected[r["row_id"]][1:5] and r["verified"]
    for levels in (1, 2):  # groups of eight leaves fetch nodes of several levels
        whole = merkle_manifest.prove(manifest, levels=levels).withColumn("proof", F.sha2("siblings", 256))
        same_rows([(r["row_id"], r["root"], r["proof"]) for r in whole.collect()], [(e[0], e[3], e[4]) for e in expected.values()])
    forged = some.withColumn("presented", F.sha2(F.lit("x").cast("binary"), 256))
    assert not any(r["verified"] for r in merkle_manifest.verify(forged).collect())


def test_missing_nodes_are_the_least():
    for known, n in (({0}, 1), ({3}, 9), (set(range(8)), 64), ({0, 70}, 75), (set(range(75)), 75)):
        asked = merkle_manifest.missing_nodes(known, n)
        levels = levels_of([sha(str(i)) for i in range(n)])
        have = [{} for _ in levels]
        for level, i in asked:
            have[level][i] = levels[level][i]
        have[0].update({i: levels[0][i] for i in known})
        assert merkle_manifest._filled(have, n) == levels[-1][0]
    assert merkle_manifest.missing_nodes(set(range(75)), 75) == []
    assert len(merkle_manifest.missing_nodes({3}, 64)) == 14


def test_a_lone_leaf_is_the_root(spark):
    docs = spark.createDataFrame([(1, "A", "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    manifest = merkle_manifest.build(docs)
    row = merkle_manifest.verify(merkle_manifest.prove(manifest)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == manifest.root == leaf_of(1, None, "en", None, "A")
