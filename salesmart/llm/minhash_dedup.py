"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._components import components
from salesmart.llm._shared import SPACED, U64, as_long, keyed, mix, shingle_hashes, text_views, word_hashes
from salesmart.session import materialise

#: A pair at 0.8 shares none of 32 bands of 5 coordinates with probability (1 - 0.8 ** 5) ** 32 = 3e-6.
BANDS, ROWS = 32, 5
SLOT_BITS = 22
_GATHER = 2048


@lru_cache(maxsize=2)
def _shifted(length: int, seed: int) -> np.ndarray:
    """Row s holds the second permutation at slot s under ``length`` circular shifts, as a view without copies."""
    slots = np.random.Generator(np.random.PCG64(seed)).permutation(1 << SLOT_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([slots[1 - length :], slots]), length)


def signature(shingles: np.ndarray, length: int = BANDS * ROWS, seed: int = 7) -> np.ndarray:
    """Circulant MinHash: the first permutation scatters the shingles over slots, coordinate k is the minimum of the second
    permutation, shifted by k, over these slots. The shifts of a slot lie side by side, so a coordinate costs one load."""
    rows = _shifted(length, seed)
    slots = (mix(shingles + U64(seed)) >> U64(64 - SLOT_BITS)).astype(np.int64)
    least = np.full(length, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(slots), _GATHER):
        np.minimum(least, rows[slots[i : i + _GATHER]].min(0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mix(key * U64(0x9E3779B97F4A7C15) + column.astype(U64))
    return as_long(key)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether each of 1,024 bins holds an odd number of shingles, as 16 words. Two sets that differ in k elements differ in
    at most k bins, so comparing these words bounds the difference from below, whatever the sets are."""
    odd = np.bincount((shingles >> U64(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids, bands, parities = [], [], [], []
            for body in text_views(batch.column("text")):
                found = np.unique(shingle_hashes(word_hashes(body, SPACED), size))
                counts.append(len(found))
                if len(found):
                    total = np.array([mix(found).sum(), mix(found ^ U64(0x5DEECE66D5DEECE6)).sum()], U64)
                    ids.append(total.tobytes())
                    bands.append(band_keys(signature(found)))
                    parities.append(parity(found))
                else:
                    ids.append(None)
                    bands.append(None)
                    parities.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "set_id", "bands", "parity"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_long(np.unique(shingle_hashes(word_hashes(body, SPACED), size))) for body in text_views(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(found, pa.list_(pa.int64()))], names=["set_id", "shingles"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``a`` may be in very many pairs, so it is joined last."""
    sides = [sets.select(F.col("set_id").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab"]
    both = pairs.join(sides[1], "b").join(sides[0], "a")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(100 * shared >= percent * (F.size("a_set") + F.size("b_set") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: classes of documents linked by Jaccard similarity.

    A document's set holds its distinct shingles of ``size`` words (a shorter text's whole sequence as one). Documents with
    equal sets are one class from the start, so thousands of copies cost one signature. Classes that share a band meet in
    its bucket. The member whose other buckets are the largest leads a bucket, and all are compared with it; that joins a
    group of near copies through its common origin. Members that are then still apart from their leader's component are
    compared with every member of another component, so no link between components is lost and no pair inside one is
    made; pairs whose parity bins prove too large a difference are ruled out inside that join. Every link is confirmed on
    full sets. The component id is the smallest doc_id reachable.

    Texts without words are linked with nothing; an empty table gives no rows; repeated rows are all returned. A row without
    doc_id links like any other, and its component takes the smallest id that there is.
    """
    rows = keyed(docs)
    sketches = materialise(rows.mapInArrow(_sketches(size), "doc_id long, text_key long, n_shingles long, set_id binary, bands array<long>, parity array<long>"))
    full = sketches.where("n_shingles > 0")
    classes = materialise(full.groupBy("set_id").agg(F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity")))
    banded = classes.select("set_id", "n", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = materialise(banded.join(shared, "bucket"))
    reach = members.groupBy("set_id").agg(F.sum("members").alias("reach"))
    leaders = members.join(reach, "set_id").groupBy("bucket").agg(F.max_by("set_id", F.struct("reach", "set_id")).alias("leader"), F.max_by("n", F.struct("reach", "set_id")).alias("leader_n"))
    alike = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    led = materialise(members.join(leaders, "bucket"))
    pairs = led.where((F.col("leader") != F.col("set_id")) & alike("leader_n", "n")).select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct()

    wanted = members.select("set_id").distinct().join(classes.select("set_id", "one"), "set_id")
    texts = rows.join(wanted.select("set_id", F.col("one.doc_id").alias("doc"), F.col("one.text_key").alias("key")), F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key")))
    sets = materialise(texts.select("set_id", "text").mapInArrow(_sets(size), "set_id binary, shingles array<long>").dropDuplicates(["set_id"]))

    links = materialise(_verified(pairs, sets, percent))
    labels = components(links)
    own = labels.select(F.col("node").alias("set_id"), "label")
    lead = labels.select(F.col("node").alias("leader"), F.col("label").alias("leader_label"))
    placed = led.join(own, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    placed = materialise(placed.join(lead, "leader", "left").withColumn("leader_label", F.coalesce("leader_label", "leader")).select("bucket", "set_id", "n", "label", "leader_label"))
    apart = placed.where("label != leader_label").select("bucket", F.col("set_id").alias("x"), F.col("n").alias("x_n"), F.col("label").alias("x_label"))
    if not apart.isEmpty():
        mixed = apart.select("bucket").distinct()
        others = placed.join(mixed, "bucket").select("bucket", F.col("set_id").alias("y"), F.col("n").alias("y_n"), F.col("label").alias("y_label"))
        bins = lambda x: classes.select(F.col("set_id").alias(x), F.col("parity").alias(f"{x}_bins"))
        differ = sum((F.bit_count(F.col("x_bins")[i].bitwiseXOR(F.col("y_bins")[i])) for i in range(1, 16)), F.bit_count(F.col("x_bins")[0].bitwiseXOR(F.col("y_bins")[0])))
        open_pairs = apart.join(bins("x"), "x").alias("l").join(
            others.join(bins("y"), "y").alias("r"),
            (F.col("l.bucket") == F.col("r.bucket")) & (F.col("x_label") != F.col("y_label")) & alike("x_n", "y_n") & (differ * (100 + percent) <= (F.col("x_n") + F.col("y_n")) * (100 - percent)),
        )
        done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more = open_pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
        links = materialise(links.unionByName(_verified(more, sets, percent)))
        labels = components(links)
    grouped = classes.select("set_id", "first_doc").join(labels.select(F.col("node").alias("set_id"), "label"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    smallest = grouped.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    of_class = grouped.join(smallest, "label").select("set_id", "component_id")
    columns = ["doc_id", "text_key", "n_shingles"]
    linked = full.select(*columns, "set_id").join(of_class, "set_id").select(*columns, "component_id")
    alone = sketches.where("n_shingles = 0").select(*columns, F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with the columns they came with."""
    gone = near_duplicates(docs, size, percent).where("NOT kept").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__doc"]) & (key == gone["__key"]), "left_anti")
