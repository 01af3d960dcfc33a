"""Code lengths of texts under a context tree over bytes, weighted over all depths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import BLOCK, SPACED, U64, as_long, keyed, mix, text_views, word_hashes
from salesmart.llm.suffix_dedup import _pack, _unpack
from salesmart.session import materialise

DEPTH = 5
#: Bytes of text that are counted or scored at a time, and bytes of text for each shard of the model.
UNIT_BYTES, SHARD_BYTES = 4 << 20, 8 << 20
#: Contexts of up to two bytes, of which there are 65,793 at any size of the input, are known to all tasks.
_NEAR = 2
#: Never part of UTF-8: stands before a text and ends it.
END = 0xFF
_FAR = 3  # context bytes up to here are always kept whole


def _lower(body: np.ndarray) -> np.ndarray:
    return np.where((body >= 0x41) & (body <= 0x5A), body | 0x20, body).astype(U64)


def pair_keys(body: np.ndarray, bits: int = 8, depth: int = DEPTH) -> np.ndarray:
    """(context << 8 | byte) for each byte of the text and its end; the last byte before is the lowest of the context.

    Of context bytes beyond the third, ``bits`` bits of a fixed scramble are kept, so a smaller model merges contexts but
    stays a tree."""
    s = np.concatenate([np.full(depth, END, U64), _lower(body), np.full(1, END, U64)])
    n = len(body) + 1
    key = s[depth:].copy()
    for d in range(1, depth + 1):
        before = s[depth - d : depth - d + n]
        key |= (before if d <= _FAR else _coarse(before, bits)) << U64(8 * d)
    return key


def _coarse(b: np.ndarray, bits: int) -> np.ndarray:
    return b if bits == 8 else ((b * U64(0x9D)) & U64(0xFF)) >> U64(8 - bits)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _gamma(zeros + 0.5) + _gamma(ones + 0.5) - _gamma(zeros + ones + 1.0) - np.log(np.pi)


def _gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5, by the recurrence up to 8 and Stirling's series."""
    low = np.zeros_like(x, float)
    y = x.astype(float)
    for _ in range(8):
        small = y < 8
        low += np.where(small, np.log(y), 0.0)
        y = y + small
    i = 1 / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + i / 12 - i**3 / 360 + i**5 / 1260 - low


def _parent(node: np.ndarray, d: int) -> np.ndarray:
    return (((node >> U64(8)) & U64((1 << 8 * (d - 1)) - 1)) << U64(8)) | (node & U64(0xFF))


def _levels(keys: np.ndarray, counts: np.ndarray, low: int, depth: int) -> dict:
    """Nodes of each depth from ``low`` on, with their zeros and ones."""
    out = {}
    for d in range(low, depth + 1):
        pairs, inverse = np.unique(keys & U64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        out[d] = ContextTree._level(pairs, np.bincount(inverse, counts, len(pairs)))
    return out


def _upward(levels: dict, above: np.ndarray | None = None) -> np.ndarray:
    """Turn counts into estimates and shares, from the deepest level up; ``above`` is what the children of the deepest level
    given add up to. Returns the weighted log probabilities of the topmost level."""
    for d in sorted(levels, reverse=True):
        node, zeros, ones = levels[d]
        own = _kt(zeros, ones)
        total = own if above is None else np.logaddexp(own, above) + np.log(0.5)
        share = np.ones(len(node)) if above is None else np.exp(np.log(0.5) + own - total)
        levels[d] = (node, (ones + 0.5) / (zeros + ones + 1.0), share)
        if d - 1 in levels:
            above = np.bincount(np.searchsorted(levels[d - 1][0], _parent(node, d)), total, len(levels[d - 1][0]))
    return total


def _downward(levels: dict, said: np.ndarray, left: np.ndarray) -> tuple[dict, dict, np.ndarray, np.ndarray]:
    """Nodes and predictions of each level, and what the last level hands to its children; ``said`` and ``left`` are what
    the nodes of the first level got."""
    nodes, one = {}, {}
    for d in sorted(levels):
        node, estimate, share = levels[d]
        # Kept from 0 and 1, which 32 bits round to where a bit was met some ten million times.
        nodes[d], one[d] = node, np.clip(said + left * estimate, 6e-8, 1 - 6e-8).astype(np.float32)
        said, left = said + left * share * estimate, left * (1 - share)
        if d + 1 in levels:
            up = np.searchsorted(node, _parent(levels[d + 1][0], d + 1))
            said, left = said[up], left[up]
    return nodes, one, said, left


class _Table:
    """Values of known keys, in an open hash table of at most half load."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.table, self.value, self.probes = np.zeros(size, U64), np.zeros(size, np.float32), 0
        home, left = self._home(keys, size), np.arange(len(keys))
        while len(left):
            at = (home[left] + self.probes) & (size - 1)
            free = self.table[at] == 0
            first = np.unique(at[free], return_index=True)[1]
            put = left[free][first]
            self.table[at[free][first]], self.value[at[free][first]] = keys[put] + U64(1), values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            self.probes += 1

    @staticmethod
    def _home(keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(65 - size.bit_length())).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the places of keys that are not known."""
        size, out = len(self.table), np.zeros(len(keys))
        at, todo = self._home(keys, size), np.arange(len(keys))
        for p in range(self.probes):
            where = (at if not p else at[todo] + p) & (size - 1)
            met = self.table[where] == (keys if not p else keys[todo]) + U64(1)
            if not p:
                out, todo = np.where(met, self.value[where].astype(np.float64), 0.0), np.flatnonzero(~met)
            else:
                out[todo[met]] = self.value[where[met]]
                todo = todo[~met]
        return out, todo


class ContextTree:
    """Predictions of a trained tree.

    Each byte is eight binary decisions; a node is a context of 0 to ``depth`` bytes with the bits of the byte so far. From
    the deepest level up, a node's weighted probability is half its own estimate's and half its children's product. The
    share of a node's own estimate follows from that; the prediction at the deepest node that training has met is the sum
    over all its ancestors of share times estimate, which is kept per node."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits: int, depth: int = DEPTH):
        self.bits, self.depth = bits, depth
        levels = _levels(keys, counts, 0, depth)
        _upward(levels)
        self.nodes, self.one, _, _ = _downward(levels, np.zeros(len(levels[0][0])), np.ones(len(levels[0][0])))
        known = np.unique(keys)
        self.known = _Table(known, self._slow(known))

    @staticmethod
    def _level(pairs: np.ndarray, counts: np.ndarray):
        byte, context = pairs & U64(0xFF), pairs >> U64(8)
        keys, zeros, ones = [], [], []
        for k in range(8):
            node = (context << U64(8)) | U64(1 << k) | (byte >> U64(8 - k))
            bit = ((byte >> U64(7 - k)) & U64(1)).astype(bool)
            u, inverse = np.unique(node, return_inverse=True)
            keys.append(u)
            ones.append(np.bincount(inverse, counts * bit, len(u)))
            zeros.append(np.bincount(inverse, counts * ~bit, len(u)))
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        return keys[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]

    def _slow(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each byte in its context, bit by bit."""
        byte, context = keys & U64(0xFF), keys >> U64(8)
        total = np.zeros(len(keys))
        for k in range(8):
            m = U64(1 << k) | (byte >> U64(8 - k))
            one = np.full(len(keys), 0.5)
            todo = np.arange(len(keys))
            for d in sorted(self.nodes, reverse=True):
                want = ((context[todo] & U64((1 << 8 * d) - 1)) << U64(8)) | m[todo]
                at = np.minimum(np.searchsorted(self.nodes[d], want), len(self.nodes[d]) - 1)
                met = self.nodes[d][at] == want
                one[todo[met]] = self.one[d][at[met]]
                todo = todo[~met]
                if not len(todo):
                    break
            bit = ((byte >> U64(7 - k)) & U64(1)).astype(bool)
            total += np.log10(np.where(bit, one, 1 - one))
        return total

    def log10(self, keys: np.ndarray) -> np.ndarray:
        out, unknown = self.known.find(keys)
        if len(unknown):
            out[unknown] = self._slow(keys[unknown])
        return out

    def score(self, body: np.ndarray) -> float:
        """log10 probability of the text and its end; long texts are worked through in blocks."""
        total = 0.0
        for at in range(0, len(body) + 1, BLOCK):
            lead = min(self.depth, at)
            part = pair_keys(body[at - lead : at + BLOCK], self.bits, self.depth)
            last = at + BLOCK > len(body)
            total += float(self.log10(part[lead:] if last else part[lead:-1]).sum())
        return total


class Shard(ContextTree):
    """The deep levels of a part of the contexts, below the near levels that all parts share."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, near: tuple):
        self.bits, self.depth = 8, DEPTH
        nodes, one, said, left = near
        self.nodes, self.one = dict(nodes), dict(one)
        if len(keys):
            levels = _levels(keys, counts, _NEAR + 1, DEPTH)
            _upward(levels)
            up = np.searchsorted(nodes[_NEAR], _parent(levels[_NEAR + 1][0], _NEAR + 1))
            deep = _downward(levels, said[up], left[up])
            self.nodes |= deep[0]
            self.one |= deep[1]


def _text_keys(body: np.ndarray) -> Iterator[np.ndarray]:
    """Keys of a text and its end, a block at a time."""
    for at in range(0, len(body) + 1, BLOCK):
        lead = min(DEPTH, at)
        key = pair_keys(body[at - lead : at + BLOCK])
        yield key[lead:] if at + BLOCK > len(body) else key[lead:-1]


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs; empties the list and sorts in place, to hold the keys only once."""
    keys = np.concatenate(parts)
    parts.clear()
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def _dealt(keys: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Places of the keys of each shard; contexts that agree in their last three bytes stay together."""
    shard = (mix((keys >> U64(8)) & U64(0xFFFFFF)) % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    values, first = np.unique(shard[order], return_index=True)
    return list(zip(values.tolist(), np.split(order, first[1:]), strict=True)) if len(keys) else []


def _pairs(shards: int):
    """Counts of each pair, combined over UNIT_BYTES of text at a time and dealt to the shards."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = _distinct(parts)
        out = [(shard, _pack([keys[rows], n[rows].astype(np.int64)])) for shard, rows in _dealt(keys, shards)]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["shard", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for body in text_views(batch.column("text")):
                for key in _text_keys(body):
                    parts.append(key)
                    held += len(key)
                    if held > UNIT_BYTES:
                        yield counted(parts)
                        parts, held = [], 0
        if parts:
            yield counted(parts)

    return run


_COUNTED = [np.uint64, np.int64]


def _merged(table: pa.Table) -> pa.Table:
    """All counts of a shard."""
    keys, n = (np.concatenate(c) for c in zip(*(_unpack(blob, _COUNTED) for blob in table.column("payload").to_pylist()), strict=True))
    keys, inverse = np.unique(keys, return_inverse=True)
    return pa.table({"shard": table.column("shard")[:1], "payload": pa.array([_pack([keys, np.bincount(inverse, n, len(keys)).astype(np.int64)])], pa.binary())})


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the deep levels of each shard add to the nodes of contexts of two bytes."""
    for batch in batches:
        for blob in batch.column("payload").to_pylist():
            keys, n = _unpack(blob, _COUNTED)
            levels = _levels(keys, n.astype(float), _NEAR + 1, DEPTH)
            node, zeros, ones = levels[_NEAR + 1]
            up, inverse = np.unique(_parent(node, _NEAR + 1), return_inverse=True)
            sums = [np.bincount(inverse, x, len(up)) for x in (_upward(levels), zeros, ones)]
            yield pa.RecordBatch.from_arrays([pa.array(as_long(up)), *map(pa.array, sums)], names=["node", "above", "zeros", "ones"])


def train(docs: DataFrame, shards: int) -> tuple[DataFrame, tuple | None]:
    """The pairs of all texts of ``docs`` by shard, and the near levels of the tree; None without rows.

    Pairs are combined in the tasks and then by shard, whole at any number of them. A shard holds all contexts that agree in
    their last three bytes and weights its levels below alone; what it adds to contexts of two bytes is summed, and these
    few levels are finished on the driver."""
    counted = keyed(docs).select("text").mapInArrow(_pairs(shards), "shard int, payload binary")
    model = materialise(counted.groupBy("shard").applyInArrow(_merged, "shard int, payload binary"))
    tops = model.mapInArrow(_tops, "node long, above double, zeros double, ones double")
    got = tops.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("above", "zeros", "ones"))).orderBy("node").toArrow().combine_chunks()
    if not got.num_rows:
        return model, None
    node, above, zeros, ones = (got.column(c).to_numpy() for c in ("node", "above", "zeros", "ones"))
    levels = {_NEAR: (node.view(U64), zeros, ones)}
    for d in range(_NEAR, 0, -1):
        node, zeros, ones = levels[d]
        up, inverse = np.unique(_parent(node, d), return_inverse=True)
        levels[d - 1] = (up, np.bincount(inverse, zeros, len(up)), np.bincount(inverse, ones, len(up)))
    _upward(levels, above)
    return model, _downward(levels, np.zeros(len(levels[0][0])), np.ones(len(levels[0][0])))


def _asked(shards: int):
    """Units of whole texts (shard -1), and for each unit and shard the distinct keys that its texts hold."""

    def unit(number: int, rows: list[pa.RecordBatch], parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = _distinct(parts)[0]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for piece in rows:
                writer.write_batch(piece)
        out = [(-1, sink.getvalue().to_pybytes())] + [(shard, _pack([keys[at]])) for shard, at in _dealt(keys, shards)]
        return pa.RecordBatch.from_arrays([pa.array([number] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["unit", "shard", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows, parts, held, fresh = [], [], 0, 0
        for batch in batches:
            begin = 0
            for i, body in enumerate(text_views(batch.column("text"))):
                for key in _text_keys(body):
                    parts.append(key)
                    held, fresh = held + len(key), fresh + len(key)
                    if fresh > 2 * UNIT_BYTES:  # inside one long text
                        parts, fresh = [_distinct(parts)[0]], 0
                if held > UNIT_BYTES:
                    yield unit(number, [*rows, batch.slice(begin, i + 1 - begin)], parts)
                    rows, parts, held, fresh, begin, number = [], [], 0, 0, i + 1, number + 1
            if begin < batch.num_rows:
                rows.append(batch.slice(begin))
        if rows:
            yield unit(number, rows, parts)

    return run


def _answered(shared):
    """log10 of the probability of each key that was asked of a shard."""

    def run(model: pa.Table, asked: pa.Table) -> pa.Table:
        near, out = shared.value, []
        wanted = asked.column("payload").to_pylist()
        if wanted and near is not None:
            held = [_unpack(blob, _COUNTED) for blob in model.column("payload").to_pylist()]
            shard = Shard(*(held[0] if held else (np.zeros(0, U64), np.zeros(0))), near)
        for blob in wanted:
            keys = _unpack(blob, [np.uint64])[0]
            values = np.full(len(keys), -np.log10(256.0)) if near is None else shard._slow(keys)
            out.append(_pack([keys, values.astype(np.float32)]))
        return pa.table({"unit": asked.column("unit"), "payload": pa.array(out, pa.binary())})

    return run


#: The most frequent words, looked up in a broadcast table; counts of all others are joined.
FREQUENT = 1 << 17


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [word_hashes(body, SPACED) for body in text_views(batch.column("text"))]
        keys, n = np.unique(np.concatenate(words) if words else np.zeros(0, U64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(as_long(keys)), pa.array(n.astype(np.int64))], names=["word", "n"])


def _tree_scores(bodies: list[np.ndarray], table: _Table) -> np.ndarray:
    """Sums over the keys of each text, looked up for many texts at once."""
    total, pieces, held = np.zeros(len(bodies)), [], 0

    def add() -> None:
        values = table.find(np.concatenate([k for _, k in pieces]))[0]
        starts = np.cumsum([0, *(len(k) for _, k in pieces[:-1])])
        np.add.at(total, [i for i, _ in pieces], np.add.reduceat(values, starts))

    for i, body in enumerate(bodies):
        for key in _text_keys(body):
            pieces.append((i, key))
            held += len(key)
            if held > BLOCK:
                add()
                pieces, held = [], 0
    if pieces:
        add()
    return total


def _scored(shared):
    """Scores of the texts of a unit, from the answers of all shards."""

    def run(units: pa.Table, answers: pa.Table) -> pa.Table:
        keys, counts, end_count, floor = shared.value
        parts = [_unpack(blob, [np.uint64, np.float32]) for blob in answers.column("payload").to_pylist()]
        table = _Table(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        docs = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in units.column("payload").to_pylist()]).combine_chunks()
        bodies = list(text_views(docs.column("text")))
        out: list[list] = [[], [], [], []]
        for body in bodies:
            words = word_hashes(body, SPACED)
            at = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
            met = keys[at] == words if len(keys) else np.zeros(len(words), bool)
            base = np.log10(counts[at[met]] + 1.0).sum() + np.log10(end_count + 1.0) - (len(words) + 1) * floor
            for column, value in zip(out, (len(words) + 1, int(met.sum()) + (end_count > 0), float(base), as_long(words[~met])), strict=True):
                column.append(value)
        n_tokens, n_known, base_score, others = (pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64())), strict=True))
        return pa.table(
            [docs.column("doc_id"), docs.column("text_key"), n_tokens, n_known, base_score, pa.array(_tree_scores(bodies, table)), others],
            names=["doc_id", "text_key", "n_tokens", "n_known", "base_score", "score", "others"],
        )

    return run


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, text_key, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    ``score`` is the log10 probability of the lower-cased bytes and an end mark under the context tree trained on all of
    ``training``; divided by the bytes it is the code length. ``base_score`` is that of an add-one model of words. Counts of
    the ``FREQUENT`` commonest words are broadcast; rarer words, none of which is a hot key, are joined with the counts of
    all words. The tree is kept in shards whose number grows with the input; units of texts ask each shard for the values of
    the distinct keys they hold. An empty text is its end alone. Without training rows every byte has probability 1/256 and the word model
    gives 1. Repeated rows give one row."""
    spark = docs.sparkSession
    byte_count = lambda df: df.agg(F.sum(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("bytes"), F.count("*").alias("rows")).first()
    learnt = byte_count(training)
    shards = max(8, -(-max(learnt["bytes"] or 0, byte_count(docs)["bytes"] or 0) // SHARD_BYTES))
    model, near = train(training, shards)
    counts = materialise(keyed(training).select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = learnt["rows"]
    n, v = size["n"] + ends, size["v"] + (ends > 0)
    floor = float(np.log10(n + v + 1))
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).toArrow().combine_chunks()
    keys, seen = top.column("word").to_numpy().view(U64), top.column("n").to_numpy()
    order = np.argsort(keys)
    asked = materialise(keyed(docs).mapInArrow(_asked(shards), "unit long, shard int, payload binary"))
    wanted = asked.where("shard >= 0").groupBy("shard")
    answers = model.groupBy("shard").cogroup(wanted).applyInArrow(_answered(spark.sparkContext.broadcast(near)), "unit long, payload binary")
    scored = _scored(spark.sparkContext.broadcast((keys[order], seen[order], ends, floor)))
    first = materialise(
        asked.where("shard = -1").groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(scored, "doc_id long, text_key long, n_tokens long, n_known long, base_score double, score double, others array<long>")
    )
    known = counts.select("word", F.col("n").alias("c"))
    rare = first.select("doc_id", "text_key", F.explode("others").alias("word")).join(known, "word")
    more = rare.groupBy(F.col("doc_id").alias("doc"), F.col("text_key").alias("key")).agg(F.count("*").alias("known"), F.sum(F.log10(F.col("c") + 1)).alias("gain"))
    joined = first.drop("others").join(more, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_key") == F.col("key")), "left")
    return joined.select(
        "doc_id",
        "text_key",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        "score",
    ).dropDuplicates(["doc_id", "text_key"])
