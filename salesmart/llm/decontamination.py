"""Benchmark passages inside documents, found by a prefix-filtered join of shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import ALNUM, U64, as_long, keyed, shingle_hashes, text_views, word_hashes
from salesmart.session import materialise

#: Windows indexed in one pass over the documents: about 200 bytes each, so 40 MB is the most that is broadcast at once.
PASS_WINDOWS = 200_000
SHINGLE = 3
_CANDIDATES = 1 << 20
_FILTER_BITS = 20


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, items, words = [], [], []
            for item, body in zip(batch.column("item_id").to_pylist(), text_views(batch.column("text")), strict=True):
                w = word_hashes(body, ALNUM)
                length = min(size, len(w))
                if length:
                    ids.append(as_long(shingle_hashes(w, size)))
                    items += [item] * len(ids[-1])
                    words += [w[i : i + length].tobytes() for i in range(len(ids[-1]))]
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(items, pa.string()), pa.array(words, pa.binary())],
                    names=["window_id", "item_id", "words"],
                )

    return run


def benchmark_windows(benchmark: DataFrame, size: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """window_id, item_id, words (hashes of the words) of each distinct window of each item."""
    items = benchmark.select(F.col(item).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    found = items.where("text IS NOT NULL AND item_id IS NOT NULL").mapInArrow(
        _windows(size), "window_id long, item_id string, words binary"
    )
    return found.distinct()


class _Index:
    """Windows of one pass; the arrays are concatenated over windows, ``base`` is where each begins."""

    def __init__(self, ids: list[int], words: list[bytes]):
        each = [np.frombuffer(w, U64) for w in words]
        self.ids = np.array(ids, np.int64)
        self.length = np.array([len(w) for w in each], np.int64)
        self.width = np.where(self.length < SHINGLE, 1, SHINGLE)
        shingles = [shingle_hashes(w, int(k)) for w, k in zip(each, self.width, strict=True)]
        self.count = np.array([len(s) for s in shingles], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.count)])[:-1]
        self.shingles = np.concatenate(shingles)
        self.owner = np.repeat(np.arange(len(each)), self.count)
        self.offset = np.arange(len(self.shingles)) - self.base[self.owner]

    def vocabulary(self) -> dict[int, np.ndarray]:
        return {k: np.unique(self.shingles[self.width[self.owner] == k]) for k in sorted(set(self.width.tolist()))}

    def prefixes(self, frequency: dict[int, int], containment: float) -> dict[int, dict[str, np.ndarray]]:
        """For each shingle width the prefix shingles, sorted, with the windows and offsets each stands for.

        A window of n shingles that must share at least m = ceil(containment * n) of them shares one of its n - m + 1
        rarest, so these are all that need to be looked up."""
        seen = np.array([frequency.get(int(s), 0) for s in as_long(self.shingles)], np.int64)
        order = np.lexsort((self.shingles, seen, self.owner))
        rank = np.empty(len(order), np.int64)
        rank[order] = self.offset  # shingles of a window stand together in both orders
        needed = self.count - np.ceil(containment * self.count - 1e-9).astype(np.int64) + 1
        chosen = rank < needed[self.owner]
        out = {}
        for k in sorted(set(self.width.tolist())):
            pick = np.flatnonzero(chosen & (self.width[self.owner] == k))
            pick = pick[np.argsort(self.shingles[pick], kind="stable")]
            keys, first = np.unique(self.shingles[pick], return_index=True)
            out[k] = {"keys": keys, "ends": np.append(first, len(pick)), "window": self.owner[pick], "offset": self.offset[pick]} | _filter(keys)
        return out


def _filter(keys: np.ndarray) -> dict[str, np.ndarray]:
    flags = np.zeros(1 << _FILTER_BITS, bool)
    flags[(keys >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return {"flags": flags}


def _lookup(shingles: np.ndarray, keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the shingles that are keys, and the number of each one's key."""
    at = np.flatnonzero(flags[(shingles >> U64(64 - _FILTER_BITS)).astype(np.int64)])
    k = np.minimum(np.searchsorted(keys, shingles[at]), len(keys) - 1)
    same = keys[k] == shingles[at]
    return at[same], k[same]


def _frequencies(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {k: (keys, _filter(keys)["flags"], np.zeros(len(keys), np.int64)) for k, keys in vocabulary.value.items()}
        for batch in batches:
            for body in text_views(batch.column("text")):
                words = word_hashes(body, ALNUM)
                for k, (keys, flags, totals) in index.items():
                    if len(words) >= k:
                        _, found = _lookup(shingle_hashes(words, k), keys, flags)
                        np.add.at(totals, found, 1)
        for keys, _, totals in index.values():
            seen = totals > 0
            yield pa.RecordBatch.from_arrays([pa.array(as_long(keys[seen])), pa.array(totals[seen])], names=["shingle", "n"])

    return run


def _covering(shared, containment: float):
    def occurrences(words: np.ndarray, index: _Index, prefixes: dict) -> tuple[np.ndarray, np.ndarray]:
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, p in prefixes.items():
            if len(words) < k:
                continue
            shingles = shingle_hashes(words, k)
            at, key = _lookup(shingles, p["keys"], p["flags"])
            many = p["ends"][key + 1] - p["ends"][key]
            upto = np.cumsum(many)
            done = 0
            while done < len(at):  # a block of candidates at a time, at least one position
                stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + _CANDIDATES, "right")))
                n = many[done:stop]
                entry = np.repeat(p["ends"][key[done:stop]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                window = p["window"][entry]
                start = np.repeat(at[done:stop], n) - p["offset"][entry]
                fits = (start >= 0) & (start + index.length[window] <= len(words))
                start, window = start[fits], window[fits]
                equal = np.zeros(len(start), np.int64)
                for j in range(int(index.count[window].max()) if len(window) else 0):
                    on = np.flatnonzero(j < index.count[window])
                    equal[on] += shingles[start[on] + j] == index.shingles[index.base[window[on]] + j]
                good = equal >= np.ceil(containment * index.count[window] - 1e-9)
                starts.append(start[good])
                windows.append(window[good])
                done = stop
        return np.concatenate(starts), np.concatenate(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, prefixes = shared.value
        for batch in batches:
            n_words, spans, found = [], [], []
            for body in text_views(batch.column("text")):
                words = word_hashes(body, ALNUM)
                start, window = occurrences(words, index, prefixes)
                depth = np.zeros(len(words) + 2, np.int64)
                np.add.at(depth, start + 1, 1)
                np.add.at(depth, start + 1 + index.length[window], -1)
                edge = np.diff((np.cumsum(depth) > 0).astype(np.int8))
                n_words.append(len(words))
                spans.append(np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1).astype(np.int64).tobytes() if len(start) else b"")
                found.append(np.unique(index.ids[window]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(spans, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_words", "spans", "windows"],
            )

    return run


def _merged(lists: pd.Series) -> pd.Series:
    """Union of the span lists of all passes, as [start, end) pairs."""

    def one(parts):
        spans = sorted(tuple(x) for p in parts for x in np.frombuffer(p, np.int64).reshape(-1, 2).tolist())
        out: list[list[int]] = []
        for a, b in spans:
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [x for pair in out for x in pair]

    return lists.map(one)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, containment: float = 1.0) -> DataFrame:
    """doc_id, text_key, n_words, hit_spans (word offsets, start and end alternating), n_hit and items (sorted item ids).

    Words are runs of ASCII letters, digits and non-ASCII characters with A-Z lower-cased. A window is ``size``
    consecutive words of an item, or the whole of a shorter item. Shingles of three words (one, in windows of one or two)
    are ordered by how often the documents hold them; only the rarest n - m + 1 of each window are joined with the
    documents, the offset of the match fixes where the window would lie, windows reaching over either end are ruled out,
    and what is left is compared shingle by shingle. With ``containment`` 1 a window occurs if all its words do, in order.

    A benchmark of any size is handled: it is indexed ``PASS_WINDOWS`` distinct windows at a time, each pass reads the
    documents anew, and only such a bounded index is broadcast. One row per (doc_id, text); repeated rows give one row.
    Items without words, null items and null texts have no windows; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    rows = keyed(docs)
    pairs = materialise(benchmark_windows(benchmark, size))
    distinct = pairs.groupBy("window_id").agg(F.first("words").alias("words"))
    total = distinct.count()
    passes = max(1, math.ceil(total / PASS_WINDOWS * 1.25)) if total > PASS_WINDOWS else 1
    results = []
    for i in range(passes):
        mine = distinct if passes == 1 else distinct.where(F.pmod(F.xxhash64("window_id"), F.lit(passes)) == i)
        got = mine.collect()
        if got:
            index = _Index([r["window_id"] for r in got], [bytes(r["words"]) for r in got])
            vocabulary = spark.sparkContext.broadcast(index.vocabulary())
            counted = rows.select("text").mapInArrow(_frequencies(vocabulary), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
            prefixes = index.prefixes({r["shingle"]: r["n"] for r in counted.collect()}, containment)
            shared = spark.sparkContext.broadcast((index, prefixes))
            results.append(rows.mapInArrow(_covering(shared, containment), "doc_id long, text_key long, n_words long, spans binary, windows array<long>"))
    if not results:
        shared = spark.sparkContext.broadcast((_Index([0], [np.zeros(1, U64).tobytes()]), {}))
        results.append(rows.mapInArrow(_covering(shared, containment), "doc_id long, text_key long, n_words long, spans binary, windows array<long>"))
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    merge = F.pandas_udf(_merged, "array<long>")
    found = materialise(
        every.groupBy("doc_id", "text_key", "n_words").agg(F.collect_set("spans").alias("parts"), F.array_distinct(F.flatten(F.collect_set("windows"))).alias("windows"))
    )
    hits = found.where(F.size("windows") > 0)
    named = [F.col("doc_id").alias("doc"), F.col("text_key").alias("key")]
    spans = hits.select(*named, merge("parts").alias("hit_spans"))
    items = (
        hits.select(*named, F.explode("windows").alias("window_id"))
        .join(pairs.select("window_id", "item_id"), "window_id")
        .groupBy("doc", "key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    joined = found
    for side in (spans, items):
        joined = joined.join(side, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key")), "left").drop("doc", "key")
    none = F.array().cast("array<long>")
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("hit_spans", none).alias("hit_spans"),
        F.coalesce(F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, x: x - total), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with the columns they came with."""
    bad = contamination(docs, benchmark, size).where("n_hit > 0").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__doc"]) & (key == bad["__key"]), "left_anti")
