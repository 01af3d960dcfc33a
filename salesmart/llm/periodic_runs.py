"""Periodic runs of words: suffix-tree longest common extensions and Lyndon roots extended both ways."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import SPACED, keyed, shingle_hashes, text_views, word_bounds, word_hashes

MIN_LENGTH = 12
RUNS = "array<struct<start:long,length:long,period:long>>"

# --- suffix trees ------------------------------------------------------------------------------------------------------


class SuffixTree:
    """Ukkonen's tree of a sequence of symbols below ``width`` that ends with a symbol found nowhere else."""

    def __init__(self, symbols: list[int], width: int):
        self.symbols, self.width, n = symbols, width, len(symbols)
        begin, end, link = [0], [0], [0]
        child: dict[int, int] = {}  # (node, first symbol of an edge) -> node below it
        node = edge = length = waiting = 0
        for i, symbol in enumerate(symbols):
            waiting += 1  # suffixes that are in the tree only implicitly
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                key = node * width + symbols[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = begin[below]
                    span = min(end[below], i + 1) - at
                    if length >= span:  # walk down
                        edge += span
                        length -= span
                        node = below
                        continue
                    if symbols[at + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(begin)
                    begin += [at, i]
                    end += [at + length, n]
                    link += [0, 0]
                    child[key] = split
                    child[split * width + symbol] = split + 1
                    begin[below] = at + length
                    child[split * width + symbols[at + length]] = below
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - waiting + 1
                else:
                    node = link[node]
        keys = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(keys)
        self.kids = np.fromiter(child.values(), np.int64, len(child))[order].tolist()
        cuts = np.searchsorted(keys[order] // width, np.arange(len(begin) + 1))
        self.cuts = cuts.tolist()  # the edges of node v are kids[cuts[v]:cuts[v + 1]], by their first symbol
        self.spans = (np.array(end) - np.array(begin)).tolist()
        self.begin = begin

    def ranks(self, descending: bool = False) -> np.ndarray:
        """The rank of each suffix, by symbols or by symbols in descending order; the last symbol 0 stays the least."""
        n, order, stack = len(self.symbols), [], [(0, 0)]
        kids, cuts, spans = self.kids, self.cuts, self.spans
        while stack:
            v, depth = stack.pop()
            a, b = cuts[v], cuts[v + 1]
            if a == b:
                order.append(n - depth)
                continue
            below = [(w, depth + spans[w]) for w in kids[a:b]]
            if not descending:
                below.reverse()  # the one pushed last comes first
            elif self.symbols[self.begin[kids[a]]] == 0:
                below.append(below.pop(0))
            stack += below
        out = np.zeros(n, np.int64)
        out[order] = np.arange(n)
        return out

    def extensions(self) -> Extensions:
        """An Euler tour: the depth of each node met, and where the leaf of each suffix is met first."""
        n, kids, spans = len(self.symbols), self.kids, self.spans
        following, last = self.cuts[:-1], self.cuts[1:]
        tour, place, path = [0], [0] * n, [(0, 0)]
        while path:
            v, depth = path[-1]
            k = following[v]
            if k == last[v]:
                path.pop()
                if path:
                    tour.append(path[-1][1])
                continue
            following[v] = k + 1
            w = kids[k]
            below = depth + spans[w]
            if following[w] == last[w]:
                place[n - below] = len(tour)
                tour += (below, depth)
            else:
                tour.append(below)
                path.append((w, below))
        return Extensions(np.array(tour, np.int32), np.array(place, np.int64))


class Extensions:
    """Longest common extensions as depths of lowest common ancestors: the least depth on the tour between two leaves, in
    constant time by minima inside blocks of 16 and a sparse table over the blocks."""

    def __init__(self, tour: np.ndarray, place: np.ndarray):
        self.place, n = place, len(tour)
        self.tour = np.full(-(-n // 16) * 16, np.iinfo(np.int32).max, np.int32)
        self.tour[:n] = tour
        blocks = self.tour.reshape(-1, 16)
        self.ahead = np.minimum.accumulate(blocks, 1).ravel()
        self.behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.sparse = [blocks.min(1)]
        while 2 * (1 << (len(self.sparse) - 1)) <= len(blocks):
            low, half = self.sparse[-1], 1 << (len(self.sparse) - 1)
            self.sparse.append(np.minimum(low[:-half], low[half:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on equal those from j on, for different positions i and j."""
        a, b = np.minimum(self.place[i], self.place[j]), np.maximum(self.place[i], self.place[j])
        first, last = a >> 4, b >> 4
        out = np.minimum(self.behind[a], self.ahead[b])
        near = np.flatnonzero(first == last)
        if len(near):
            out[near] = self.tour[a[near]]
            for k in range(1, 16):
                out[near] = np.minimum(out[near], self.tour[np.minimum(a[near] + k, b[near])])
        between = last - first - 1
        far = np.flatnonzero(between > 0)
        if len(far):
            level = np.frexp(between[far])[1] - 1
            for x in np.unique(level):
                some = far[level == x]
                table = self.sparse[x]
                out[some] = np.minimum(out[some], np.minimum(table[first[some] + 1], table[last[some] - (1 << int(x))]))
        return out.astype(np.int64)


# --- runs --------------------------------------------------------------------------------------------------------------


def _next_smaller(ranks: np.ndarray) -> np.ndarray:
    """The next suffix that is smaller: the longest Lyndon word from a position ends there. The last position has none."""
    values, out, stack = ranks.tolist(), [len(ranks)] * len(ranks), []
    for i in range(len(values) - 1, -1, -1):
        while stack and values[stack[-1]] > values[i]:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], min_length: int) -> np.ndarray:
    """start, length and period of all runs of at least ``min_length`` symbols, which are positive numbers.

    Each run contains, for one of the two orders of the symbols, a root that is the longest Lyndon word at its position;
    so the longest Lyndon words of both orders are all candidates there are, one for each position and order."""
    n, width = len(symbols), max(symbols) + 1
    tree = SuffixTree([*symbols, 0], width)
    roots = [_next_smaller(tree.ranks(down))[:n] for down in (False, True)]
    forward = tree.extensions()
    del tree
    backward = SuffixTree([*symbols[::-1], 0], width).extensions()
    i, j = np.tile(np.arange(n), 2), np.concatenate(roots)
    left = np.zeros(2 * n, np.int64)
    inner = i > 0
    left[inner] = backward.of(n - i[inner], n - j[inner])
    period, start = j - i, i - left
    length = left + period + forward.of(i, j)
    found = np.stack([start, length, period], 1)[(length >= 2 * period) & (length >= min_length)]
    return np.unique(found, axis=0)


def stretches(hashes: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Stretches of words outside which no run can lie.

    Inside a run of period q, a sequence of k <= min_length / 2 words occurs again q words further on or back, but for at
    most k - 1 places in its middle. So only stretches of repeated sequences with such gaps can hold runs. Equal hashes of
    different words only make stretches longer."""
    if len(hashes) < min_length:
        return []
    k = min(4, min_length // 2)
    grams = shingle_hashes(hashes, k)
    order = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(same):
        return []
    places = np.unique(np.concatenate([order[same], order[same + 1]]))
    breaks = np.flatnonzero(np.diff(places) > k)
    begins, ends = places[np.append(0, breaks + 1)], places[np.append(breaks, len(places) - 1)] + k
    return [(int(a), int(b)) for a, b in zip(begins, ends, strict=True) if b - a >= min_length]


def document_runs(body: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the words of one text (start, length, period, sorted by start and period), and the bounds of the words.

    The suffix trees hold the stretches of a text that can hold runs, with a symbol of its own behind each."""
    starts, stops = word_bounds(body, SPACED)
    numbers: dict[bytes, int] = {}
    symbols: list[int] = []
    origin: list[int] = []
    parts = stretches(word_hashes(body, SPACED), min_length)
    for a, b in parts:
        words = bytes(body[starts[a] : stops[b - 1]]).split()
        symbols += [numbers.setdefault(w, len(numbers) + 1) for w in words]
        symbols.append(0)
        origin += range(a, b + 1)
    if not parts:
        return np.zeros((0, 3), np.int64), starts, stops
    symbols.pop()
    fresh = len(numbers)
    for i, symbol in enumerate(symbols):
        if symbol == 0:
            fresh += 1
            symbols[i] = fresh
    found = runs_of(symbols, min_length)
    found[:, 0] = np.array(origin)[found[:, 0]]
    return found, starts, stops


def collapsed(body: np.ndarray, runs: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> bytes:
    """The words joined by single blanks, without those that some run holds after its first period."""
    raw = body.tobytes()
    if not len(runs):
        return b" ".join(raw.split())
    depth = np.zeros(len(starts) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
    return b" ".join([raw[a:b] for a, b in zip(starts[kept].tolist(), stops[kept].tolist(), strict=True)])


def _search(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bounds, rows, texts = [], [0], [], []
            for body in text_views(batch.column("text")):
                found, starts, stops = document_runs(body, min_length)
                counts.append(len(starts))
                rows.append(found)
                bounds.append(bounds[-1] + len(found))
                texts.append(collapsed(body, found, starts, stops))
            table = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            fields = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(3)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), runs, pa.array(texts, pa.binary())],
                names=["doc_id", "text_key", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, text_key, n_words, runs (start, length, period; by start and period), collapsed of every row.

    Words are runs of bytes that are no ASCII white space, compared exactly. A run is a stretch of at least
    max(``min_length``, 2 * period) words with that smallest period which no neighbouring word extends; ``min_length`` is 2
    or more. collapsed holds the words (UTF-8 bytes, joined by one blank) that no run contains after its first period.

    Null and empty texts have no words; a null doc_id stays null; repeated rows are all returned; only doc_id and text are
    read, so other columns never clash; an empty table gives an empty one. Nothing is shuffled. Trees need some 600 bytes a
    word, but only for stretches that repeat sequences of four words; a text of any length without such stretches needs its
    bytes and hashes."""
    if min_length < 2:
        raise ValueError("a run has at least two words")
    rows = keyed(docs)
    return rows.mapInArrow(_search(min_length), f"doc_id long, text_key long, n_words long, runs {RUNS}, collapsed binary")


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, or for one id in ten its words with a periodic tail: h is crc32 of the id in decimal, g = floor(h / 10), and
    if h % 10 = 0 each word i >= a = g % n of the n words becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    every = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def rebuilt(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)).cast("long") + 1
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(words, i)), " ")).otherwise(text)

    return F.when(h % 10 == 0, F.get(F.transform(F.array(every), rebuilt), F.lit(0))).otherwise(text)
