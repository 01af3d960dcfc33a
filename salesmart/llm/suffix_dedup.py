"""Bytes covered by long strings that occur earlier in the corpus, by a distributed merge sort of suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import BYTE_VALUES, U64, _Powers, keyed, mix, text_views
from salesmart.session import materialise

LENGTH, ANCHOR = 100, 32
REACH = LENGTH - ANCHOR  # a string may begin this far before its anchor
#: Bytes of text whose anchors meet in one group, on average.
GROUP_BYTES = 8 << 20
_CHUNK = 1 << 20
_BLOBS = "dest long, payload binary"
_SPANS = "doc_id long, tag int, start long, n int, anchor binary"
_TAG = 0xFFFF


# --- anchors -----------------------------------------------------------------------------------------------------------


def blocks(body: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor position, first and last start, anchor hash and content hash of each block of a text.

    Every string of ``LENGTH`` bytes selects one anchor: the leftmost of its substrings of ``ANCHOR`` bytes with the least
    hash. Equal strings select the same one at the same place, so a string can only be repeated if its anchor is. A block is
    a maximal run of consecutive starts with one anchor; its content reaches to the end of its last string."""
    parts, n = [], len(body) - LENGTH + 1
    for at in range(0, max(n, 0), _CHUNK):
        piece = body[at : min(len(body), at + _CHUNK + LENGTH - 1)]
        up, down = _Powers.of(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum(BYTE_VALUES[piece] * up[: len(piece)], out=sums[1:])
        grams = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(piece) - ANCHOR + 1])
        least = (grams & ~U64(0xFFFFFFFF)) | np.arange(len(grams), dtype=U64)
        span, width = 1, REACH + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        chosen = (least & U64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.append(first[1:], len(chosen)) - 1
        content = mix((sums[last + LENGTH] - sums[first]) * down[first] + (last - first).astype(U64))
        parts.append((chosen[first] + at, first + at, last + at, grams[chosen[first]], content))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(U64), none.view(U64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


_ENTRY = [("anchor", np.uint64), ("content", np.uint64), ("doc", np.int64), ("tag", np.uint16), ("start", np.int64), ("n", np.uint8), ("off", np.uint8)]


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns by byte planes, so that the zero bytes of small numbers lie together and compress."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return len(columns[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    n, raw, at, out = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def _runs(groups: int):
    """Entries of one batch of documents, dealt by anchor; copies inside the batch travel apart from their first."""
    kinds = [k for _, k in _ENTRY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            each: list[list[np.ndarray]] = [[] for _ in _ENTRY]
            for doc, key, body in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), text_views(batch.column("text")), strict=True):
                at, first, last, anchor, content = blocks(body)
                ones = np.ones(len(at), np.int64)
                for column, value in zip(each, (anchor, content, ones * doc, ones * (key & _TAG), first, last - first + 1, at - first), strict=True):
                    column.append(value)
            if not each[0]:
                continue
            entry = [np.concatenate(c).astype(k) for c, k in zip(each, kinds, strict=True)]
            keep, again = _firsts(entry)
            dest = (entry[0] % U64(groups)).astype(np.int64)
            out = [(int(d), b"\x00" + _pack([c[rows] for c in entry])) for d, rows in _dealt(dest, keep)]
            if len(again):
                dest = (entry[0] * U64(0x9E3779B97F4A7C15) + entry[4].astype(U64) + U64(number)) % U64(groups)
                out += [(int(d), b"\x01" + _pack([c[rows] for c in entry[2:6]])) for d, rows in _dealt(dest.astype(np.int64), again)]
            for i in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out[i : i + 64]], pa.int64()), pa.array([x[1] for x in out[i : i + 64]], pa.binary())], names=["dest", "payload"])

    return run


def _dealt(dest: np.ndarray, rows: np.ndarray):
    rows = rows[np.argsort(dest[rows], kind="stable")]
    values, first = np.unique(dest[rows], return_index=True)
    for value, part in zip(values, np.split(rows, first[1:]), strict=True):
        yield value, part


def _firsts(entry: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are the earliest of their content, and rows that are not; a row that is there twice counts once."""
    anchor, content, doc, tag, start = entry[:5]
    order = np.lexsort((start, tag, doc, content, anchor))
    same = np.zeros(len(order), bool)
    same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (content[order][1:] == content[order][:-1])
    twin = same.copy()
    for c in (doc, tag, start):
        twin[1:] &= c[order][1:] == c[order][:-1]
    return order[~same], order[same & ~twin]


def _gather(table: pa.Table) -> pa.Table:
    """All entries of a group of anchors: spans that repeat an earlier block whole, and, with their anchor's number, the
    first blocks of anchors that occur in different blocks, whose strings are still to be compared."""
    fresh, gone = [], []
    for blob in table.column("payload").to_pylist():
        (gone if blob[0] else fresh).append(_unpack(blob[1:], [k for _, k in (_ENTRY[2:6] if blob[0] else _ENTRY)]))
    out = [[np.concatenate(c) for c in zip(*gone, strict=True)]] if gone else []
    marks: list[np.ndarray | None] = [None] if gone else []
    if fresh:
        entry = [np.concatenate(c) for c in zip(*fresh, strict=True)]
        keep, again = _firsts(entry)
        out.append([c[again] for c in entry[2:6]])
        marks.append(None)
        anchor = entry[0][keep]
        mixed = np.zeros(len(keep), bool)
        mixed[1:] = anchor[1:] == anchor[:-1]
        mixed[:-1] |= anchor[1:] == anchor[:-1]
        rows = keep[mixed]
        out.append([c[rows] for c in entry[2:6]])
        marks.append(entry[6][rows])
    arrays = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4)]
    flat: list = []
    for o, m in zip(out, marks, strict=True):
        flat += [None] * len(o[0]) if m is None else [int(x).to_bytes(1, "little") for x in m]
    return pa.table(
        {"doc_id": pa.array(arrays[0].astype(np.int64)), "tag": pa.array(arrays[1].astype(np.int32)), "start": pa.array(arrays[2].astype(np.int64)), "n": pa.array(arrays[3].astype(np.int32)), "anchor": pa.array(flat, pa.binary())}
    )


# --- sorted runs and their merge ---------------------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = known
    width = 16
    while a[step : step + width] == b[step : step + width]:
        step += width
    while a[step] == b[step]:
        step += 1
    return step


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Sorted strings as lengths of common prefixes and the bytes after them."""
    shared, rests, before = np.zeros(len(suffixes), np.uint8), [], b""
    for i, s in enumerate(suffixes):
        shared[i] = common_prefix(before, s)
        rests.append(s[shared[i] :])
        before = s
    return shared, b"".join(rests)


class _Run:
    """Reads a front-coded run in order."""

    def __init__(self, shared: np.ndarray, lengths: np.ndarray, rest: bytes, base: int):
        self.shared, self.lengths, self.rest = shared.tolist(), lengths.tolist(), rest
        self.at, self.offset, self.base, self.text, self.lcp = -1, 0, base, b"", 0

    def next(self) -> bool:
        self.at += 1
        if self.at == len(self.shared):
            return False
        self.lcp = self.shared[self.at]
        more = self.lengths[self.at] - self.lcp
        self.text = self.text[: self.lcp] + self.rest[self.offset : self.offset + more]
        self.offset += more
        return True


def merge_runs(runs: list[_Run]) -> tuple[list[int], list[int]]:
    """Numbers of the strings of all runs in sorted order, and the common prefix of each with the one before it.

    A loser tree whose nodes keep, with the loser, its common prefix with the last winner. A challenger with the longer such
    prefix wins unread; only equal prefixes are compared, from the byte behind them on, so no byte known to agree is read
    again."""
    k = 1
    while k < len(runs):
        k *= 2
    live = [r if i < len(runs) and r.next() else None for i, r in enumerate(runs + [None] * (k - len(runs)))]
    depth = [0] * k  # common prefix of each run's string with the last winner
    losers = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        ra, rb = live[a], live[b]
        if ra is None or rb is None:
            return (b, a) if ra is None else (a, b)
        if depth[a] != depth[b]:
            return (a, b) if depth[a] > depth[b] else (b, a)
        h = common_prefix(ra.text, rb.text, depth[a])
        if ra.text[h : h + 1] <= rb.text[h : h + 1]:
            depth[b] = h
            return a, b
        depth[a] = h
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    order, prefixes = [], []
    while live[winner] is not None:
        run = live[winner]
        order.append(run.base + run.at)
        prefixes.append(depth[winner])
        if run.next():
            depth[winner] = run.lcp
        else:
            live[winner] = None
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, prefixes


_WIRE = [np.uint8, np.uint8, np.int64, np.uint16, np.int64, np.uint8, np.uint8]


def _sorted_runs(groups: int):
    """Contexts of the open blocks of a batch, sorted by what follows the anchor's start, as one front-coded run a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            docs, tags, packed, opened = (batch.column(c).to_pylist() for c in ("doc_id", "tag", "packed", "open"))
            by: dict[int, list[tuple]] = {}
            for doc, tag, z, blocks_ in zip(docs, tags, packed, opened, strict=True):
                text = unpack.decompress(z) if len(z) else b""
                for block in blocks_:
                    at = block["start"] + block["anchor"][0]
                    suffix = text[at : at + LENGTH]
                    left = text[max(0, at - REACH) : at]
                    dest = hash_of(suffix[:ANCHOR]) % groups
                    by.setdefault(dest, []).append((suffix, left[::-1], doc, tag, block["start"], block["n"], block["anchor"][0]))
            dests, payloads = [], []
            for dest, rows in by.items():
                rows.sort(key=lambda r: r[0])
                shared, rest = front_coded([r[0] for r in rows])
                meta = _pack([shared, *(np.array(c, k) for c, k in zip(([len(r[0]) for r in rows], *zip(*(r[2:] for r in rows), strict=True)), _WIRE[1:], strict=True))])
                lefts = b"".join(r[1].ljust(REACH, b"\0") for r in rows)
                body = zstandard.ZstdCompressor(level=1).compress(rest + lefts)
                payloads.append(len(meta).to_bytes(8, "little") + len(rest).to_bytes(8, "little") + meta + body)
                dests.append(dest)
            for i in range(0, len(dests), 64):
                yield pa.RecordBatch.from_arrays([pa.array(dests[i : i + 64], pa.int64()), pa.array(payloads[i : i + 64], pa.binary())], names=["dest", "payload"])

    return run


def hash_of(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=7).digest(), "little")


def _settle(table: pa.Table) -> pa.Table:
    """Merge the runs of a group and find the strings that also begin earlier."""
    runs, columns, lefts, base = [], [], [], 0
    for blob in table.column("payload").to_pylist():
        m, r = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
        meta = _unpack(blob[16 : 16 + m], _WIRE)
        body = zstandard.ZstdDecompressor().decompress(blob[16 + m :])
        runs.append(_Run(meta[0], meta[1], body[:r], base))
        columns.append(meta[2:])
        lefts.append(np.frombuffer(body, np.uint8, len(meta[0]) * REACH, r).reshape(-1, REACH))
        base += len(meta[0])
    found: list[tuple] = []
    if base:
        order, prefixes = merge_runs(runs)
        doc, tag, start, n, off = (np.concatenate(c)[order] for c in zip(*columns, strict=True))
        found = repeated_strings(np.array(prefixes), np.concatenate(lefts)[order], doc, tag, start, n.astype(np.int64), off.astype(np.int64))
    return pa.table({"doc_id": pa.array([f[0] for f in found], pa.int64()), "tag": pa.array([f[1] for f in found], pa.int32()), "start": pa.array([f[2] for f in found], pa.int64()), "n": pa.array([f[3] for f in found], pa.int32()), "anchor": pa.nulls(len(found), pa.binary())})


def repeated_strings(prefixes, left, doc, tag, start, n, off) -> list[tuple]:
    """Spans of starts whose string has an earlier twin, from suffixes in sorted order and their common prefixes.

    For strings that begin x bytes before the anchor, suffixes whose neighbours share LENGTH - x bytes stand together, and
    those of them with the same x bytes on the left are equal strings: the earliest stays."""
    count = len(prefixes)
    place = start + off
    rank = np.empty(count, np.int64)
    rank[np.lexsort((place, tag, doc))] = np.arange(count)
    behind = np.zeros(count, U64)
    rows, xs = [], []
    for x in range(REACH + 1):
        if x:
            behind = mix(behind * U64(0x100000001B3) + left[:, x - 1] + U64(1))
        on = np.flatnonzero((off - n + 1 <= x) & (x <= off))
        if len(on) > 1:
            joint = np.cumsum(prefixes < LENGTH - x)[on]
            order = np.lexsort((rank[on], behind[on], joint))
            a = on[order]
            again = np.flatnonzero((joint[order][1:] == joint[order][:-1]) & (behind[a][1:] == behind[a][:-1])) + 1
            rows.append(a[again])
            xs.append(np.full(len(again), x))
    row, x = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (rows, xs))
    if not len(row):
        return []
    order = np.lexsort((-x, row))  # starts ascend as x falls
    row, begin = row[order], place[row[order]] - x[order]
    heads = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1)]))
    sizes = np.diff(np.append(heads, len(row)))
    return list(zip(doc[row[heads]].tolist(), tag[row[heads]].tolist(), begin[heads].tolist(), sizes.tolist(), strict=True))


# --- removal -----------------------------------------------------------------------------------------------------------


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [zstandard.ZstdCompressor(level=1).compress(body.tobytes()) if len(body) else b"" for body in text_views(batch.column("text"))]
        tags = [k & _TAG for k in batch.column("text_key").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(tags, pa.int32()), pa.array(packed, pa.binary())], names=["doc_id", "text_key", "tag", "packed"])


def covered(n_bytes: int, spans: list) -> np.ndarray:
    """Which bytes lie in a string that begins in one of the spans."""
    depth = np.zeros(n_bytes + 1, np.int64)
    for span in spans:
        depth[span["start"]] += 1
        depth[span["start"] + span["n"] - 1 + LENGTH] -= 1
    return np.cumsum(depth)[:n_bytes] > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for z, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            text = zstandard.ZstdDecompressor().decompress(z) if len(z) else b""
            gone = covered(len(text), spans or [])
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
            for column, value in zip(out, (len(text), int(gone.sum()), int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1)), kept), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
            names=["doc_id", "text_key", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tag, start, n: spans of starts of strings of 100 bytes that also begin earlier in the corpus.

    Earlier is a smaller doc_id or an earlier start in the same document; texts of one doc_id are told apart and ordered by
    16 bits of their hash. Strings whose anchor is unique are never moved. Blocks equal to an earlier block are settled by
    64-bit fingerprints of their content, first inside each batch, so a passage in a third of all documents sends one entry
    a batch. For the other blocks of a repeated anchor, suffixes go as sorted front-coded runs to the group of their first
    32 bytes, where a loser tree merges them; the common prefixes it yields decide every string.
    """
    rows = keyed(docs).where("doc_id IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(8, -(-size // GROUP_BYTES))
    met = materialise(rows.mapInArrow(_runs(groups), _BLOBS).groupBy("dest").applyInArrow(_gather, _SPANS))
    opened = met.where("anchor IS NOT NULL").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("open"))
    texts = rows.mapInArrow(_compress, "doc_id long, text_key long, tag int, packed binary")
    runs = texts.dropDuplicates(["doc_id", "tag"]).join(opened, ["doc_id", "tag"])
    settled = runs.select("doc_id", "tag", "packed", "open").mapInArrow(_sorted_runs(groups), _BLOBS).groupBy("dest").applyInArrow(_settle, _SPANS)
    return met.where("anchor IS NULL").unionByName(settled).select("doc_id", "tag", "start", "n")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_bytes, n_removed, n_spans, kept (the remaining bytes, which may split a character).

    Null and empty texts have no bytes; texts under 100 bytes and rows without doc_id stay whole; repeated rows are one
    document and are all returned; matches never cross documents."""
    spans = repeated_spans(docs).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    texts = keyed(docs).mapInArrow(_compress, "doc_id long, text_key long, tag int, packed binary")
    joined = texts.join(spans, ["doc_id", "tag"], "left").select("doc_id", "text_key", "packed", "spans")
    return joined.mapInArrow(_cut, "doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, kept binary")
