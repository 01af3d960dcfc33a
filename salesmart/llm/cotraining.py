"""Document quality from two views that teach each other: what a text says and what its metadata say."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import FOLD5, SPACED, U64, fold, text_views, word_bounds, word_hashes
from salesmart.session import materialise

#: Most labelled rows that the classifiers are fitted on; all unlabelled rows outside the held-out fold teach.
TRAIN_ROWS = 8_000
#: Rounds of teaching, the certainty a pseudo-label needs, and the most that all of them together weigh, per labelled row.
ROUNDS, CONFIDENT, TAUGHT = 4, 0.95, 0.3
#: Newton steps end when no weight moves by more.
STILL = 1e-4
#: Rows of sums that reach the driver for each step and view.
_SUMS = 16
#: Hashed words; statistics of the bytes and lines before them.
WORD_FEATURES = 64
TEXT_FEATURES, META_FEATURES = 20 + WORD_FEATURES, 64
_SIGN = np.zeros(256, bool)
_SIGN[[*b"%*&$#@^~|<>{}[]=+_\\/"]] = True


def text_features(body: np.ndarray) -> np.ndarray:
    """Shares of kinds of bytes, word and line statistics of a whole text, and how its words fall into hashed groups."""
    n = max(1, len(body))
    counts = np.bincount(body, minlength=256)
    starts, stops = word_bounds(body, SPACED)
    lengths = stops - starts if len(starts) else np.zeros(1, np.int64)
    last = body[stops - 1] if len(starts) else np.zeros(0, np.uint8)
    first = body[starts] if len(starts) else np.zeros(0, np.uint8)
    words = max(1, len(starts))
    lines = int(counts[10]) + 1
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    words_in = np.bincount((word_hashes(body, SPACED) >> U64(58)).astype(np.int64), minlength=WORD_FEATURES) / words
    statistics = np.array(
        [
            1.0,
            np.log1p(len(body)) / 10,
            upper / n * 5,
            lower / n,
            digits / n * 5,
            counts[128:].sum() / n,
            counts[_SIGN].sum() / n * 5,
            counts[ord("!")] / n * 10,
            counts[ord("|")] / words * 2,
            counts[ord(".")] / words * 5,
            counts[ord(",")] / words * 5,
            lengths.mean() / 10,
            lengths.std() / 10,
            min(3.0, lengths.max() / 50),
            _SIGN[last].mean() if len(last) else 0.0,
            ((first >= 65) & (first <= 90)).mean() if len(first) else 0.0,
            np.log1p(words / lines) / 5,
            np.log1p(lines) / 5,
            (counts > 0).sum() / 100,
            float(len(starts) == 0),
        ]
    )
    return np.concatenate([statistics, 4 * words_in])


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language and source, and the stated length by powers of two; an absent value is a value of its own."""
    out = np.zeros(META_FEATURES)
    out[0] = 1.0
    out[1 + zlib.crc32(f"l{lang}".encode()) % 13] = 1.0
    out[14 + zlib.crc32(f"s{source}".encode()) % 33] = 1.0
    out[47 + (16 if n_chars is None else min(15, max(0, n_chars).bit_length()))] = 1.0
    return out


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = [text_features(b) for b in text_views(batch.column("text"))]
    meta = [meta_features(*m) for m in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")), strict=True)]
    return np.array(text).reshape(-1, TEXT_FEATURES), np.array(meta).reshape(-1, META_FEATURES)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, meta = _views(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(list(text), pa.list_(pa.float64())), pa.array(list(meta), pa.list_(pa.float64()))],
            names=["doc_id", "label", "text_view", "meta_view"],
        )


def _dense(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = batch.column("text_view").flatten().to_numpy().astype(float).reshape(-1, TEXT_FEATURES)
    meta = np.zeros((batch.num_rows, META_FEATURES))
    np.put_along_axis(meta, batch.column("meta_on").flatten().to_numpy().reshape(batch.num_rows, -1), 1.0, 1)
    return text, meta


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both views of a row, the sparse one by the places of its ones: some 400 bytes, however long the text."""
    for batch in batches:
        text, meta = _views(batch)
        on = [np.flatnonzero(m) for m in meta]
        views = [pa.array(list(text.astype(np.float32)), pa.list_(pa.float32())), pa.array(on, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *views], names=["doc_id", "text_view", "meta_on"])


def _sums(teach: list, learn: list):
    """Number, gradient and Hessian of the rows that the other view is sure of, summed in each task for both views."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [0.0, 0.0]
        g = [np.zeros(len(w)) for w in learn]
        h = [np.zeros((len(w), len(w))) for w in learn]
        for batch in batches:
            if not batch.num_rows:
                continue
            views = _dense(batch)
            for v in (0, 1):  # each is taught by the other
                p = 1 / (1 + np.exp(-np.clip(views[1 - v] @ teach[1 - v], -30, 30)))
                sure = np.maximum(p, 1 - p) >= CONFIDENT
                x, q = views[v][sure], 1 / (1 + np.exp(-np.clip(views[v][sure] @ learn[v], -30, 30)))
                n[v] += len(x)
                g[v] += x.T @ (q - (p[sure] >= 0.5))
                h[v] += (x * (q * (1 - q))[:, None]).T @ x
        part = TaskContext.get().partitionId()
        sums = [np.concatenate([[n[v]], g[v], h[v].ravel()]) for v in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([part % _SUMS] * 2, pa.int32()), pa.array([part] * 2, pa.int32()), pa.array(sums, pa.list_(pa.float64()))], names=["view", "slot", "part", "sums"]
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    rows = table.sort_by("part")
    total = np.sum(np.array(rows.column("sums").to_pylist()), 0)
    return pa.table({"view": rows.column("view")[:1], "slot": rows.column("slot")[:1], "sums": pa.array([total], pa.list_(pa.float64()))})


def _taught_by(pool: DataFrame):
    """What the whole pool adds to a Newton step of both views; only sums of fixed size reach the driver."""

    def step(teach: list, learn: list) -> list[tuple]:
        sums = pool.mapInArrow(_sums(teach, learn), "view int, slot int, part int, sums array<double>")
        rows = sums.groupBy("view", "slot").applyInArrow(_added, "view int, slot int, sums array<double>").collect()
        out = []
        for v, w in enumerate(learn):
            k = len(w)
            total = np.zeros(1 + k + k * k)
            for r in sorted((r for r in rows if r["view"] == v), key=lambda r: r["slot"]):
                total += np.array(r["sums"])
            out.append((total[0], total[1 : 1 + k], total[1 + k :].reshape(k, k)))
        return out

    return step


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return _newton([x], y, [np.zeros(x.shape[1])], None)[0]


def _newton(views: list, y: np.ndarray, start: list, taught) -> list[np.ndarray]:
    """Newton steps with a small ridge, of all views at once. All taught rows weigh alike; n of them beside m labelled
    ones weigh 0.3 m n / (n + m) together, one formula for a pool of any size, in which they never drown the labels."""
    w = [np.array(x) for x in start]
    for _ in range(25):
        more, moved = taught(w) if taught else [(0.0, 0.0, 0.0)] * len(w), 0.0
        for v, x in enumerate(views):
            n, g, h = more[v]
            weight = TAUGHT * len(y) / (n + len(y))
            p = 1 / (1 + np.exp(-np.clip(x @ w[v], -30, 30)))
            hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + weight * h + 0.1 * np.eye(x.shape[1])
            by = np.linalg.solve(hessian, x.T @ (p - y) + weight * g + 0.1 * w[v])
            w[v], moved = w[v] - by, max(moved, float(np.abs(by).max()))
        if moved < STILL:
            break
    return w


class CoTrained:
    """Two classifiers, each calibrated on labelled rows neither was fitted on, and the prior they share."""

    def __init__(self, labelled: tuple, taught=None):
        views, y = labelled[:2], labelled[2]
        self.constant = None if len(set(y.tolist())) == 2 else float(y.mean()) if len(y) else 0.5
        if self.constant is not None:
            return
        tune = np.arange(len(y)) % 4 == 0  # rows come in the order of a hash
        if len(set(y[tune].tolist())) < 2 or len(set(y[~tune].tolist())) < 2:
            tune = np.zeros(len(y), bool)
        fit, said = [x[~tune] for x in views], y[~tune]
        self.w = _newton(fit, said, [np.zeros(x.shape[1]) for x in views], None)
        for _ in range(ROUNDS if taught else 0):
            teach = self.w
            self.w = _newton(fit, said, teach, lambda learn, teach=teach: taught(teach, learn))
        check = tune if tune.any() else ~tune
        self.calibration = [_logistic(np.stack([np.ones(check.sum()), views[v][check] @ self.w[v]], 1), y[check]) for v in (0, 1)]
        z = np.stack([np.ones(check.sum()), *(self._calibrated(v, views[v][check]) for v in (0, 1))], 1)
        self.mix = _logistic(z, y[check])

    def _calibrated(self, v: int, x: np.ndarray) -> np.ndarray:
        a, b = self.calibration[v]
        return a + b * (x @ self.w[v])

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(text), self.constant)
        z = self.mix[0] + self.mix[1] * self._calibrated(0, text) + self.mix[2] * self._calibrated(1, meta)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(*_views(batch)), pa.float64())], names=["doc_id", "score"])

    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> CoTrained:
    """Classifiers from at most ``train_rows`` labelled rows outside the held-out fold, taken in the order of a hash of the
    id, and from all rows without a label. Rows that repeat an id all have its label, and each counts. Of labelled rows feature vectors reach the driver, of the others sums of fixed
    size. Rows of the held-out fold and rows without id are in neither. Without labels of both kinds every document gets the
    share of label 1 (0.5 without labels)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    seen = (fold(F.col("doc_id"), FOLD5) != 0) & F.col("doc_id").isNotNull()
    chosen = known.where(seen).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)  # bounded by train_rows
    got = _rows(docs).join(F.broadcast(chosen), "doc_id").mapInArrow(_extract, "doc_id long, label int, text_view array<double>, meta_view array<double>")
    table = got.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    views = [np.array(table.column(c).to_pylist(), float).reshape(table.num_rows, n) for c, n in (("text_view", TEXT_FEATURES), ("meta_view", META_FEATURES))]
    label = table.column("label").to_numpy().astype(float)
    if len(set(label.tolist())) < 2:
        return CoTrained((*views, label))
    # The views are taken on the scan; what is matched with the labels, and shuffled where those are many, are narrow rows.
    views_of = _rows(docs).where(seen).mapInArrow(_pool, "doc_id long, text_view array<float>, meta_on array<int>")
    pool = materialise(views_of.join(known.select("doc_id"), "doc_id", "left_anti").select("text_view", "meta_on"))
    return CoTrained((*views, label), _taught_by(pool))


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, score of every row; null texts are empty, null metadata a value of its own."""
    return _rows(docs).mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
