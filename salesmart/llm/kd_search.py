"""Exact search for the largest inner products with KD-trees per shard."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.session import materialise

SHARD_ROWS, LEAF_ROWS = 8192, 128
BLOCK_QUERIES, WAVE_BLOCKS = 256, 64
_EXACT = 2.0**53
_FOUND = "query_id long, vec_id long, score long"


def quantised(table: pa.Table, vector: str = "embedding") -> np.ndarray:
    """floor(1024 * x) of each component; whole numbers that doubles hold exactly."""
    flat = table.column(vector).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(1024 * flat.reshape(table.num_rows, -1))


class KdTree:
    """Median splits along the widest side of the tight bounding box of each node."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.low, self.high, self.child, self.rows = [], [], [], []
        self._grow(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.largest = float(np.abs(points).max()) if points.size else 0.0

    def _grow(self, rows: np.ndarray) -> int:
        node, box = len(self.low), self.points[rows]
        low, high = box.min(0), box.max(0)
        self.low.append(low)
        self.high.append(high)
        self.child.append(None)
        self.rows.append(None)
        side = int(np.argmax(high - low)) if box.shape[1] else 0
        if len(rows) <= LEAF_ROWS or not box.shape[1] or high[side] == low[side]:
            self.rows[node] = rows
            return node
        middle = np.argsort(box[:, side], kind="stable")
        half = len(rows) // 2
        self.child[node] = (self._grow(np.sort(rows[middle[:half]])), self._grow(np.sort(rows[middle[half:]])))
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, known: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query its ``k`` best (score, id) here, ties to the smaller id, without its own id; ``known`` is a kth
        score that is already reached elsewhere, below which nothing counts."""
        reach = float(np.abs(queries).max(initial=0.0)) * self.largest * max(1, queries.shape[1])
        exact = reach < _EXACT
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T if exact else np.full((len(queries), len(self.low)), np.inf)
        return [self._best(q, b, o, t, k, exact) for q, b, o, t in zip(queries, bounds, own, known, strict=True)]

    def _best(self, query, bounds, own, known, k, exact) -> list[tuple[int, int]]:
        best: list[tuple[int, int]] = []  # a heap of (score, -id): its root is the kth
        front = [(-bounds[0], 0)]
        while front:
            bound, node = heapq.heappop(front)
            floor = max(known, best[0][0]) if len(best) == k else known
            if -bound < floor:  # nothing that is left can reach the kth score
                break
            if self.child[node] is not None:
                for c in self.child[node]:
                    if bounds[c] >= floor:
                        heapq.heappush(front, (-bounds[c], c))
                continue
            rows = self.rows[node]
            if exact:
                scores = self.points[rows] @ query
            else:
                whole = [int(x) for x in query]
                scores = np.array([sum(a * int(b) for a, b in zip(whole, p, strict=True)) for p in self.points[rows]], object)
            for i in np.flatnonzero(scores >= floor).tolist():
                entry = (int(scores[i]), -int(self.ids[rows[i]]))
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in best]


def _plant(table: pa.Table) -> pa.Table:
    tree = KdTree(table.column("vec_id").to_numpy(), quantised(table))
    return pa.table({"shard": table.column("shard")[:1], "dim": table.column("dim")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})


def _block(table: pa.Table) -> pa.Table:
    data = (table.column("vec_id").to_numpy(), quantised(table), table.column("known").to_numpy(zero_copy_only=False))
    return pa.table({"block": table.column("block")[:1], "dim": table.column("dim")[:1], "queries": pa.array([pickle.dumps(data)], pa.binary())})


def _search(k: int):
    def run(trees: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        for blob in trees.column("tree").to_pylist() if blocks.num_rows else []:
            tree = pickle.loads(blob)
            for packed in blocks.column("queries").to_pylist():
                ids, points, known = pickle.loads(packed)
                for query, found in zip(ids.tolist(), tree.search(points, ids, known, k), strict=True):
                    out += [(query, vec, score) for score, vec in found]
        return pa.table([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, vec: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of floor(1024 * x) for each query row.

    Queries are the rows whose id is divisible by ``every``; candidates all rows with another id. Rows are sharded by a hash
    of id and vector; each shard of about 8,192 rows grows a KD-tree and is searched best-first, by the largest product that a box
    allows. Blocks of queries first search one shard; the kth score found there is carried to all shards, so most boxes are
    never opened. A task holds one tree and at most 64 blocks of 256 queries.

    Vectors that are null, empty or hold a null or non-finite component, and rows without id, take no part. Vectors are compared
    with those of their own length. Every row counts, as query and as candidate, also where rows repeat an id (the results of
    its rows are ranked together) or are equal: of equal rows ``k`` copies are kept, of which more could never be seen. A
    vector whose floor(1024 * x) have a sum of squares of 2**62 or more takes no part, since its scores may fit no long. An
    empty table gives no rows.
    """
    clean = vectors.select(F.col(vec).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x * 1024) < float("inf")) & ~F.isnan(x))
    )
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * 1024).cast("double"), F.lit(2.0)))
    clean = clean.where((F.size("embedding") > 0) & F.forall("embedding", lambda x: F.abs(x) < 2.0**31)).where(squares < 2.0**62)
    copies = clean.groupBy("vec_id", "embedding").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    every_copy = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    rows = materialise(copies.select("vec_id", "embedding", F.size("embedding").alias("dim"), every_copy).drop("copy"))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    waves = -(-blocks // WAVE_BLOCKS)
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    trees = materialise(sharded.groupBy("shard", "dim").applyInArrow(_plant, "shard int, dim int, tree binary"))

    def searched(known: DataFrame, targets) -> DataFrame:
        dealt = known.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding", F.lit(1)), F.lit(blocks)).cast("int"))
        packed = dealt.groupBy("block", "dim").applyInArrow(_block, "block int, dim int, queries binary")
        packed = packed.withColumn("wave", (F.col("block") / WAVE_BLOCKS).cast("int")).withColumn("shard", targets)
        grown = trees.withColumn("wave", F.explode(F.sequence(F.lit(0), F.lit(waves - 1))))
        return grown.groupBy("shard", "dim", "wave").cogroup(packed.groupBy("shard", "dim", "wave")).applyInArrow(_search(k), _FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    start = searched(asked.withColumn("known", F.lit(float("-inf"))), F.pmod(F.col("block"), F.lit(shards)).cast("int"))
    kth = start.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k)
    below = F.col("least").cast("double") - F.abs(F.col("least").cast("double")) * 1e-15  # never above a score that doubles round
    known = asked.join(kth.select(F.col("query_id").alias("vec_id"), below.alias("known")), "vec_id", "left")
    known = materialise(known.fillna(float("-inf"), ["known"]))
    found = searched(known, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
