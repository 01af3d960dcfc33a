"""Byte-level BPE: pre-tokens found by scans of transition functions, cached pair merging, decoding by retained offsets."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes of the rows that are encoded together, bytes that one scan looks at, and pre-tokens that are merged at once.
PORTION, SCAN, SLICE = 2 << 20, 1 << 19, 1 << 16
#: Entries of each of the two halves of the memo, and bytes of a remembered piece.
MEMO, REMEMBERED = 150_000, 64

# --- classes of code points --------------------------------------------------------------------------------------------

OTHER, LETTER, NUMBER, WHITE = range(4)
_PROBED = [(0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000)]  # the rest is private or unassigned in every version


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """The class of each code point, as the tokenizer library itself splits texts, whatever Unicode version it holds.

    A vocabulary of single bytes and of pairs that end in one sign shows which code points stay together with that sign."""
    classes = np.zeros(0x110000, np.uint8)
    points = np.concatenate([np.arange(a, b, dtype=np.uint32) for a, b in _PROBED])
    texts = [chr(c) for c in points]
    sizes = 2 + np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
    ends = np.cumsum(sizes)
    seen = np.full(len(points), WHITE, np.uint8)
    for kind, sign in ((LETTER, "A"), (NUMBER, "1"), (OTHER, "!")):
        ranks = {bytes([i]): i for i in range(256)} | {bytes([i, ord(sign)]): 256 + i for i in range(256)}
        probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        ids = np.array(probe.encode_ordinary("".join(f"{t}{sign}\n" for t in texts)))
        at = np.cumsum(np.where(ids >= 256, 2, 1))  # bytes up to the end of each token
        joined = np.searchsorted(ends, at[ids >= 256], side="left")
        seen[joined[points[joined] != 0x20]] = kind  # a blank goes with all three
    classes[points] = seen
    return classes


# --- the automaton, its functions and their composition ------------------------------------------------------------------

#: What follows is folded into the symbol: white space before white space or the end; the last one before other text, a blank
#: or not; an apostrophe before one or two letters of a contraction.
_OTHER, _LETTER, _NUMBER, _GAP, _BLANK, _LAST, _SHORT, _LONG = range(8)
#: After a code point: the next one begins a pre-token anyway; inside letters, numbers, others; after a blank that belongs to
#: what follows; inside white space; one or two letters of a contraction to come.
_FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _AFTER_BLANK, _IN_GAP, _ONE_MORE, _TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether the code point begins a pre-token."""
    if symbol == _LETTER and state == _ONE_MORE:
        return _FRESH, False
    if symbol == _LETTER and state == _TWO_MORE:
        return _ONE_MORE, False
    if symbol == _GAP:
        return _IN_GAP, state != _IN_GAP
    if symbol == _BLANK:
        return _AFTER_BLANK, True
    if symbol == _LAST:
        return _FRESH, True
    inside = {_LETTER: _IN_LETTERS, _NUMBER: _IN_NUMBERS}.get(symbol, _IN_OTHERS)
    joined = state in (inside, _AFTER_BLANK)
    if symbol in (_SHORT, _LONG) and not joined:
        return (_ONE_MORE if symbol == _SHORT else _TWO_MORE), True
    return inside, not joined


_NEXT = np.array([[_step(s, x)[0] for x in range(8)] for s in range(8)], np.uint8)
_BEGINS = np.array([[_step(s, x)[1] for x in range(8)] for s in range(8)])


def _closure() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All functions from state to state that symbols can compose, their composition table, and the numbers of the function of
    each symbol, inside a text and at its start (where the state before does not matter)."""
    identity = tuple(range(8))
    inside = [tuple(int(_NEXT[s, x]) for s in range(8)) for x in range(8)]
    opening = [tuple([int(_NEXT[_FRESH, x])] * 8) for x in range(8)]
    known = {identity: 0}
    queue = [identity]
    for f in queue:
        for g in inside + opening:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = np.array(queue, np.uint8)
    compose = np.array([[known[tuple(g[x] for x in f)] for g in queue] for f in queue], np.uint16)
    return functions, compose, np.array([known[f] for f in inside], np.uint16), np.array([known[f] for f in opening], np.uint16)


_FUNCTIONS, _COMPOSE, _INSIDE, _OPENING = _closure()
_WIDTH = 64


def scan(codes: np.ndarray) -> np.ndarray:
    """The composition of all functions up to each place. Composition is associative, so rows of 64 are scanned side by side,
    their totals are scanned the same way, and what comes before a row is put in front of its places."""
    n, m = len(codes), len(_FUNCTIONS)
    rows = -(-n // _WIDTH)
    table = np.zeros(rows * _WIDTH, np.intp)
    table[:n] = codes
    table = np.ascontiguousarray(table.reshape(rows, _WIDTH).T)
    flat = _COMPOSE.ravel()
    for j in range(1, _WIDTH):
        table[j] = flat[table[j - 1] * m + table[j]]
    if rows > 1:
        before = np.zeros(rows, np.intp)
        before[1:] = scan(table[-1])[:-1]
        table = flat[before * m + table]
    return table.T.ravel()[:n]


def _code_points(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code points that begin at ``starts``; the body goes on for three bytes after the last one."""
    out, found = body[starts].astype(np.uint32), []
    for lead, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        some = np.flatnonzero((out >= lead) & (out < (0xE0, 0xF0, 0x100)[more - 1]))
        value = out[some] & bits
        for k in range(1, more + 1):
            value = (value << 6) | (body[starts[some] + k] & 0x3F)
        found.append((some, value))
    for some, value in found:
        out[some] = np.minimum(value, 0x10FFFF)
    return out


_SINGLE, _PAIRS = np.frombuffer(b"stmd", np.uint8), [tuple(x) for x in (b"re", b"ve", b"ll")]


def pretoken_starts(body: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte offsets at which pre-tokens begin in texts laid end to end; ``firsts`` are the offsets of the texts that are not
    empty. Works through the bytes in blocks, which hand on their last state."""
    found, state, at = [], _FRESH, 0
    padded = np.concatenate([body, np.zeros(4, np.uint8)])
    while at < len(body):
        end = min(len(body), at + SCAN)
        while end < len(body) and body[end] & 0xC0 == 0x80:
            end += 1
        ahead = min(len(body), end + 8)
        starts = np.flatnonzero((body[at:ahead] & 0xC0) != 0x80) + at
        points = _code_points(padded, starts)
        kinds = classes[points]
        n = int(np.searchsorted(starts, end))
        opens = np.zeros(len(starts) + 2, bool)  # the text ends before such a code point
        opens[np.searchsorted(starts, firsts[(firsts >= at) & (firsts < ahead)])] = True
        if ahead == len(body):
            opens[len(starts) :] = True
        one, two = np.append(points, [0, 0])[1 : n + 1], np.append(points, [0, 0])[2 : n + 2]
        one = np.where(opens[1 : n + 1], 0, one)
        two = np.where(opens[2 : n + 2] | (one == 0), 0, two)
        follows = ~opens[1 : n + 1] & (np.append(kinds, WHITE)[1 : n + 1] != WHITE)
        points, kinds, starts = points[:n], kinds[:n], starts[:n]
        symbols = kinds.copy()  # the first four symbols are the classes
        last = (kinds == WHITE) & follows
        symbols[last] = np.where(points[last] == 0x20, _BLANK, _LAST)
        for i in np.flatnonzero(points == 0x27):
            if one[i] in _SINGLE:
                symbols[i] = _SHORT
            elif (one[i], two[i]) in _PAIRS:
                symbols[i] = _LONG
        states = _FUNCTIONS[scan(np.where(opens[:n], _OPENING[symbols], _INSIDE[symbols])), state]
        before = np.concatenate([[state], states[:-1]])
        found.append(starts[_BEGINS[before, symbols] | opens[:n]])
        state, at = states[-1], end
    return np.concatenate(found) if found else np.zeros(0, np.int64)


# --- pair merging ------------------------------------------------------------------------------------------------------


class Merger(dict):
    """Token ids of pre-tokens as packed 32-bit numbers: a memo of bounded size over pair merging by rank.

    When the newer half of the memo is full it becomes the older one; pieces found there move on, so frequent ones stay."""

    def __init__(self, vocabulary: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.merge(piece)).tobytes()
        if len(piece) <= REMEMBERED:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Adjacent parts with the least rank are joined, the leftmost first, until no pair has a rank."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self._few(piece) if len(piece) <= REMEMBERED else self._many(piece)

    def _few(self, piece: bytes) -> list[int]:
        """The ranks of all pairs stand in a list, which is searched for the least one each time."""
        get, none = self.ranks.get, len(self.tokens)
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[i : i + 2], none) for i in cuts[:-2]]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            del pairs[i], cuts[i + 1]
            if i < len(pairs):
                pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
        return [self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _many(self, piece: bytes) -> list[int]:
        """A heap names the next pair; entries whose parts have changed since are stale."""
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n))  # the part that begins at i ends at after[i]
        heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(heap)
        alive = bytearray([1]) * n
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if not alive[i] or middle >= n or after[middle] != end:
                continue
            alive[middle] = 0
            after[i] = end
            if end < n:
                before[end] = i
                rank = ranks.get(piece[i : after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            if i:
                rank = ranks.get(piece[before[i] : end])
                if rank is not None:
                    heapq.heappush(heap, (rank, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def ids(self, blob: memoryview, starts: np.ndarray) -> np.ndarray:
        """Ids of the pre-tokens that begin at ``starts``, the last of which ends with the blob."""
        packed = []
        bounds = np.append(starts, len(blob))
        for at in range(0, len(starts), SLICE):
            cut = bounds[at : at + SLICE + 1].tolist()
            body = bytes(blob[cut[0] : cut[-1]])
            origin = cut[0]
            packed.append(b"".join([self[body[a - origin : b - origin]] for a, b in zip(cut, cut[1:])]))
        return np.frombuffer(b"".join(packed), np.int32)


_MERGERS: dict[int, Merger] = {}


def _merger(vocabulary) -> Merger:
    """The vocabulary of a broadcast, built once in each worker."""
    if vocabulary.id not in _MERGERS:
        _MERGERS.clear()
        _MERGERS[vocabulary.id] = Merger(vocabulary.value)
    return _MERGERS[vocabulary.id]


class _Shared:
    """A broadcast with a number that stays the same in all its copies."""

    def __init__(self, spark: SparkSession, content: bytes):
        self.id, self.broadcast = hash(content), spark.sparkContext.broadcast(content)

    @property
    def value(self) -> bytes:
        return self.broadcast.value


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, and the offsets between them."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(ends) else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into rows of some 2 MB of text, so that what is held besides the texts stays small; at least one row each."""
    for batch in batches:
        ends = _bytes(batch.column("text"))[1]
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + PORTION, side="right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


def _encode(vocabulary, classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        table = np.frombuffer(classes.value, np.uint8)
        for batch in _portions(batches):
            body, ends = _bytes(batch.column("text"))
            firsts = ends[:-1][ends[1:] > ends[:-1]]
            ids = merger.ids(memoryview(body), pretoken_starts(body, firsts, table))
            stops = np.cumsum(merger.lengths[ids])
            counts = np.concatenate([[0], np.searchsorted(stops, ends[1:], side="right")])  # every text ends with a token
            counts[1:][ends[1:] == 0] = 0
            places = stops - merger.lengths[ids] - np.repeat(ends[:-1], np.diff(counts))
            bounds = pa.array(counts, pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32())) for x in (ids, places)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *lists], names=["doc_id", "text_key", "ids", "offsets"])

    return run


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text_key, ids array<int>, offsets array<int> (the byte of the text at which each token begins) of every row.

    Null and empty texts have no ids; a null doc_id stays null; repeated rows are all returned; only doc_id and text are
    read, so other columns never clash; an empty table gives an empty one. A text is worked through in blocks of 1 MB and a
    pre-token of any length is merged in n log n steps, so long texts need memory for their bytes and ids alone. Special
    tokens are ordinary text. Nothing is shuffled. The driver reads ``vocabulary`` and sends its bytes (under 1 MB) and the
    table of classes (1.1 MB, whatever the input) to the executors."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as lines:
        shared = _Shared(spark, lines.read())
    classes = spark.sparkContext.broadcast(code_point_classes().tobytes())
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_key"))
    return rows.mapInArrow(_encode(shared, classes), "doc_id long, text_key long, ids array<int>, offsets array<int>")


def _decode(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(vocabulary)
        for batch in batches:
            ids, places = batch.column("ids"), batch.column("offsets")
            counts = np.diff(np.asarray(ids.offsets))
            flat, at = np.asarray(ids.flatten()), np.asarray(places.flatten()).astype(np.int64)
            if len(flat) != len(at) or (len(flat) and (flat.min() < 0 or flat.max() >= len(merger.tokens))):
                raise ValueError("ids and offsets do not belong to this vocabulary")
            sizes = merger.lengths[flat]
            first = np.concatenate([[0], np.cumsum(counts)])
            some = counts > 0
            ends = np.zeros(len(counts), np.int64)
            ends[some] = at[first[1:][some] - 1] + sizes[first[1:][some] - 1]
            begins = np.zeros(len(counts), np.int64)
            begins[some] = at[first[:-1][some]]
            bounds = np.concatenate([[0], np.cumsum(ends - begins)])
            at = at + np.repeat(bounds[:-1] - begins, counts)  # the place of each token in the bytes of the batch
            if not np.array_equal(at, np.cumsum(sizes) - sizes):
                raise ValueError("offsets do not fit the lengths of the tokens")
            out = np.zeros(int(bounds[-1]), np.uint8)
            for low in range(0, len(flat), SCAN):
                part, places_of, width = flat[low : low + SCAN], at[low : low + SCAN], sizes[low : low + SCAN]
                inner = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
                out[np.repeat(places_of, width) + inner] = merger.blob[np.repeat(merger.begins[part], width) + inner]
            data = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([*batch.columns, data], names=[*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (doc_id, text_key, ids, offsets) with the column ``decoded``, the bytes of the tokens.

    Each token goes to its offset, counted from the first one of the row, so that a slice of a row's tokens decodes to that
    slice of the text, which may split a character. Offsets that do not fit the tokens fail the job. No ids give no bytes."""
    with open(vocabulary, "rb") as lines:
        shared = _Shared(encoded.sparkSession, lines.read())
    none = F.lit([]).cast("array<int>")
    rows = encoded.select("doc_id", "text_key", F.coalesce("ids", none).alias("ids"), F.coalesce("offsets", none).alias("offsets"))
    return rows.mapInArrow(_decode(shared), "doc_id long, text_key long, ids array<int>, offsets array<int>, decoded binary")
