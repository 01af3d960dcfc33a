"""Every stage of the corpus pipeline against brute force over its own input, and run() against the stages one by one."""

import random
import re

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SHARED = "Subscribe to our newsletter and never miss an update again, dear readers"
ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def corpus():
    rng = random.Random(12)
    parts = ["ba", "na", "ko", "té", "ri", "lu", "mo", "se"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
    rows, toxic = [], {}
    for i in range(420):
        words = [word() for _ in range(rng.randint(25, 60))]
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            words.insert(rng.randrange(8), rng.choice(["idiot", "moron", "scum", "1d1ot", "m o r o n", "idioooot"]))
        if i % 37 == 3:
            words[10:10] = ITEM.split()[1:12]
        text = " ".join(words)
        if i % 6 == 1:
            text = SHARED + "\n" + text
        if i % 12 == 7:
            text, toxic[i] = rows[i - 1][1].replace("ba", "BA", 1), toxic[i - 1]  # a copy up to case
        rows.append((i, text, "en" if i % 3 else "de", f"src{i % 5}", len(text)))
    rows += [(1000, "", "en", "src1", 0), (1001, None, None, None, None), (None, "ko ri na lu", "en", "src2", 11), (None, "ko ri na lu", "en", "src2", 11)]
    rows += [(1002, "ba " * 40_000, "de", "src3", 120_000), rows[2], rows[2]]
    return rows, toxic


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows, toxic = corpus()
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS label", "'x' AS bucket").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, t) for d, t in toxic.items() if d % 2], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, toxic


def key(r):
    return r["doc_id"], r["text"] or ""


def test_stages_and_run(spark, tables):
    path, toxic = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialise(stage(spark, docs, path))
        seen[name] = (docs.collect(), out.collect())
        if name != "mixing":
            assert out.columns == corpus_pipeline.COLUMNS
        docs = out

    before, after = seen["toxicity"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    bad = {d for d, t in toxic.items() if t}
    assert len(gone & bad) >= 0.9 * len(bad) and len(gone - bad) <= 2, (len(gone & bad), len(bad), len(gone - bad))
    assert sum(r["doc_id"] is None for r in after) == 2

    before, after = seen["line_dedup"]
    where = {}
    for r in before:
        for line in (r["text"] or "").split("\n"):
            where.setdefault(lowered(line.strip(" \t\n\x0b\x0c\r")), set()).add(r["doc_id"])
    shared = {k: max(d) for k, d in where.items() if len(k) >= 40 and len(d - {None}) >= 5}
    assert lowered(SHARED) in shared
    expected = []
    for r in before:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if shared.get(lowered(x.strip()), r["doc_id"]) == r["doc_id"]]
        expected.append((r["doc_id"], "\n".join(kept)))
    assert sorted(map(repr, map(key, after))) == sorted(map(repr, expected))

    before, after = seen["minhash_dedup"]
    sets = {}
    for r in before:
        words = re.findall("[^\x20\x09-\x0d]+", lowered(r["text"]))
        sets[key(r)] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {k: k[0] for k in sets}
    named = [k for k in sets if k[0] is not None and sets[k]]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(named):
            for b in named[i + 1 :]:
                if group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    kept = [key(r) for r in before if group[key(r)] == r["doc_id"]]
    assert sorted(map(repr, map(key, after))) == sorted(map(repr, kept)) and len(after) < len(before)

    before, after = seen["decontamination"]
    words_of = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(t))
    item = words_of(ITEM)
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    spoken = [(key(r), words_of(r["text"])) for r in before]
    clean = [k for k, w in spoken if not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))]
    assert sorted(map(repr, map(key, after))) == sorted(map(repr, clean)) and len(after) < len(before)

    before, after = seen["mixing"]
    size = lambda r: len((r["text"] or "").split())
    total = sum(map(size, before))
    assert {key(r) for r in after} <= {key(r) for r in before}
    assert 0.35 * total <= sum(r["n_tokens"] for r in after) <= 0.5 * total and all(r["n_tokens"] == size(r) for r in after)
    times = {}
    for r in after:
        times[key(r)] = times.get(key(r), 0) + 1
    copies = {}
    for r in before:
        copies[key(r)] = copies.get(key(r), 0) + 1
    assert all(n <= 3 * copies[k] for k, n in times.items())

    whole = corpus_pipeline.run(spark, path)
    assert sorted(map(repr, map(tuple, whole.collect()))) == sorted(map(repr, map(tuple, after)))


def test_an_empty_table_gives_an_empty_one(spark, tables, tmp_path):
    path = tables[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
