"""Token counts of edited texts, re-encoding only what an edit touches."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokens of the byte-level vocabulary: fixed by it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64
_MEMO = 400_000
EDITS = "array<struct<start:long,length:long,text:string>>"


@lru_cache(maxsize=4)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Counter(dict):
    """Tokens of single pre-tokens, a memo of bounded size."""

    def __init__(self, path: str):
        self.encode, self.pattern = _encoding(path).encode_ordinary, regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n

    def of(self, piece: str) -> int:
        return self[piece]


class TokenTree:
    """A segment tree over the pre-tokens of one text: leaves hold up to 64 pre-tokens at first, nodes hold the characters
    and tokens below them. An edit finds its leaf by characters, reads a window of leaves around it and changes the sums on
    the paths above them; the text is never put together again."""

    def __init__(self, text: str, counter: Counter):
        self.counter, self.encoded = counter, 0
        pieces = counter.pattern.findall(text)
        tokens = [counter[p] for p in pieces]
        self.parts = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self._sum([sum(tokens[i * LEAF : (i + 1) * LEAF]) for i in range(len(self.parts))])

    @classmethod
    def stored(cls, text: str, lengths: list[int], leaves: list[int], tokens: list[int], counter: Counter) -> TokenTree:
        """The tree that ``dump`` described: pre-tokens are cut by their lengths, and nothing is matched or encoded."""
        tree = cls.__new__(cls)
        tree.counter, tree.encoded, tree.parts = counter, 0, []
        at = k = 0
        for n in leaves:
            part = []
            for length in lengths[k : k + n]:
                part.append(text[at : at + length])
                at += length
            k += n
            tree.parts.append(part)
        tree._sum(tokens)
        return tree

    def dump(self) -> tuple[list[int], list[int], list[int]]:
        """Characters of each pre-token, and pre-tokens and tokens of each leaf."""
        lengths = [len(p) for part in self.parts for p in part]
        return lengths, [len(part) for part in self.parts], self.tokens[self.size : self.size + len(self.parts)]

    def _sum(self, tokens: list[int]) -> None:
        self.size = 1 << (len(self.parts) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, leaf in enumerate(self.parts):
            self.chars[self.size + i], self.tokens[self.size + i] = len("".join(leaf)), tokens[i]
        for node in range(self.size - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def leaves(self) -> list[list[tuple[int, int]]]:
        """Characters and tokens of each pre-token."""
        return [[(len(p), self.counter[p]) for p in part] for part in self.parts]

    @property
    def text(self) -> str:
        return "".join(map("".join, self.parts))

    def _locate(self, at: int) -> tuple[int, int, int]:
        """Leaf, number and first character of the pre-token that holds character ``at`` or, at the end, of the last."""
        if not self.chars[1]:
            return 0, 0, 0
        at, begin, node = min(at, self.chars[1] - 1), 0, 1
        while node < self.size:
            node *= 2
            if at >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        for i, piece in enumerate(self.parts[node - self.size]):
            if at < begin + len(piece):
                return node - self.size, i, begin
            begin += len(piece)
        raise AssertionError("positions and sums disagree")

    def edit(self, start: int, length: int, text: str) -> None:
        """Replace ``length`` characters from ``start``.

        A pre-token depends on its characters and at most two after them, so matching starts anew at the one that holds the
        second character before the edit, and ends where it meets an old boundary behind the edit. The window grows by
        whole leaves, as far as matching looks."""
        start = max(0, min(start, self.chars[1]))
        length = max(0, min(length, self.chars[1] - start))
        leaf, first, begin = self._locate(max(0, start - 2))
        old, ends = self.parts[leaf][first:], []
        ends.append(len(old))  # pre-tokens of the window up to the end of each of its leaves
        window, behind = "".join(old), start + length - begin
        while len(window) < behind:
            window += self._extend(leaf, old, ends)
        window = window[: start - begin] + text + window[behind:]
        shift, end = len(text) - length, start - begin + len(text)
        at = i = old_at = 0
        fresh: list[str] = []
        while True:
            while i < len(old) and (old_at + shift < at or old_at < behind):  # old pre-tokens that the new ones replace
                old_at += len(old[i])
                i += 1
            if at >= end and old_at + shift == at and old_at >= behind:
                break
            match = self.counter.pattern.match(window, at)
            if match is None or match.end() + 2 > len(window):
                more = self._extend(leaf, old, ends)
                if more:
                    window += more
                    continue
            if match is None:
                break
            fresh.append(match.group())
            at = match.end()
        self.encoded += len(fresh)
        kept, begin = self.parts[leaf][:first] + fresh, 0
        for place, stop in enumerate(ends, leaf):
            gone = old[begin : min(i, stop)]
            added = fresh if place == leaf else []
            if gone or added:
                self._put(place, (kept if place == leaf else []) + old[max(begin, i) : stop], added, gone)
            if i <= stop:
                break
            begin = stop

    def _extend(self, leaf: int, old: list[str], ends: list[int]) -> str:
        """Add leaves to the window until it is longer, doubling them; without any left, the result is empty."""
        text = ""
        while not text and leaf + len(ends) < len(self.parts):
            for pieces in self.parts[leaf + len(ends) : leaf + 2 * len(ends)]:
                text += "".join(pieces)
                old += pieces
                ends.append(len(old))
        return text

    def _put(self, leaf: int, pieces: list[str], added: list[str], gone: list[str]) -> None:
        """Set the pre-tokens of a leaf; the sums above change by those added and gone."""
        self.parts[leaf] = pieces
        chars = len("".join(added)) - len("".join(gone))
        tokens = sum(self.counter[p] for p in added) - sum(self.counter[p] for p in gone)
        node = self.size + leaf
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2


def _recount(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        names = ["n_tokens", "n_after", "n_pretokens", "n_encoded", "n_edits"]
        for batch in batches:
            out: list[tuple] = []
            edits = batch.column("edits")
            starts, lengths, texts = (edits.values.field(name).to_pylist() for name in ("start", "length", "text"))
            present, bounds = edits.values.is_valid().to_pylist(), edits.offsets.to_pylist()
            for row, text in enumerate(batch.column("text").to_pylist()):
                tree = TokenTree(text, counter)
                before, pieces = tree.n_tokens, sum(map(len, tree.parts))
                done = [e for e in range(bounds[row], bounds[row + 1]) if present[e] and starts[e] is not None]
                done.sort(key=starts.__getitem__, reverse=True)
                for e in done:
                    tree.edit(starts[e], lengths[e] or 0, texts[e] or "")
                out.append((before, tree.n_tokens, pieces, tree.encoded, len(done)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "text_key", *names])

    return run


def recount(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text_key, n_tokens, n_after, n_pretokens, n_encoded, n_edits for documents with a column ``edits``.

    Edits (start, length, text) refer to the characters of the original text, do not overlap, and are applied from the last
    to the first; positions beyond the text are taken as its end, and edits without a start are ignored. Null edits are none, null texts are empty.
    n_encoded counts the pre-tokens that edits caused to be encoded. Repeated rows are all returned. Tasks share nothing and
    nothing is shuffled; the vocabulary is read from ``vocabulary``, a path that every executor has."""
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS text_key", "edits")
    return rows.mapInArrow(_recount(vocabulary), "doc_id long, text_key long, n_tokens long, n_after long, n_pretokens long, n_encoded long, n_edits long")


# --- stored trees --------------------------------------------------------------------------------------------------------

_TREE = "lengths array<int>, leaves array<int>, tokens array<int>"


def _ints(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def _build(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            out, totals = [], []
            for text in batch.column("text").to_pylist():
                tree = TokenTree(text, counter)
                out.append(tree.dump())
                totals.append(tree.n_tokens)
            columns = [_ints([o[i] for o in out]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64()), *columns], names=[*batch.schema.names, "n_tokens", "lengths", "leaves", "tokens"])

    return run


def build_trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, text_key, text, n_tokens and the leaves of its tree (lengths, leaves, tokens) of every row: a table to keep.

    Null texts are empty; rows that repeat an id and a text have equal trees. Nothing is shuffled."""
    rows = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "xxhash64(coalesce(text, '')) AS text_key", "coalesce(text, '') AS text")
    return rows.mapInArrow(_build(vocabulary), f"doc_id long, text_key long, text string, n_tokens long, {_TREE}")


def _apply(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        names = ["n_after", "n_pretokens", "n_encoded", "n_edits"]
        for batch in batches:
            texts, trees, counts = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("text", "lengths", "leaves", "tokens", "edits")]
            for text, lengths, leaves, tokens, edits in zip(*columns, strict=True):
                tree = TokenTree.stored(text, lengths, leaves, tokens, counter)
                done = [e for e in edits or [] if e and e["start"] is not None]
                done.sort(key=lambda e: e["start"], reverse=True)
                for e in done:
                    tree.edit(e["start"], e["length"] or 0, e["text"] or "")
                texts.append(tree.text)
                trees.append(tree.dump())
                counts.append((tree.n_tokens, len(lengths), tree.encoded, len(done)))
            kept = [batch.column(c) for c in ("doc_id", "text_key", "n_tokens")]
            added = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            leaves = [_ints([t[i] for t in trees]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, *added, pa.array(texts, pa.string()), *leaves], names=["doc_id", "text_key", "n_tokens", *names, "text", "lengths", "leaves", "tokens"])

    return run


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts before and after of the edited rows alone, with their new text and tree, from stored trees.

    ``edits`` has one row for each edited text: doc_id, text_key, edits (as for ``recount``). Only these rows are loaded;
    of their texts only what edits touch is matched and encoded again (n_encoded pre-tokens of n_pretokens). Rows without
    an id cannot be named and are not edited; edits of texts that are not there change nothing."""
    joined = trees.join(edits.select("doc_id", "text_key", "edits"), ["doc_id", "text_key"])
    schema = f"doc_id long, text_key long, n_tokens long, n_after long, n_pretokens long, n_encoded long, n_edits long, text string, {_TREE}"
    columns = ["doc_id", "text_key", "n_tokens", "text", "lengths", "leaves", "tokens", "edits"]
    return joined.select(columns).mapInArrow(_apply(vocabulary), schema)


def edited_trees(trees: DataFrame, edited: DataFrame) -> DataFrame:
    """The table of trees after a batch: edited rows with their new tree, all others as they were."""
    fresh = edited.selectExpr("doc_id", "xxhash64(text) AS text_key", "text", "n_after AS n_tokens", "lengths", "leaves", "tokens")
    same = trees.join(edited.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_anti")
    return same.select(fresh.columns).unionByName(fresh)


_JUNK = re.compile(r"([%*&$#])\1\1|!!")


def _cleaning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, lengths, texts, ends = [], [], [], [0]
        for text in batch.column("text").to_pylist():
            text = text or ""
            for found in _JUNK.finditer(text):
                starts.append(found.start())
                lengths.append(found.end() - found.start())
                texts.append("")
            if not text.endswith("\n"):
                starts.append(len(text))
                lengths.append(0)
                texts.append("\n")
            ends.append(len(starts))
        fields = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(texts, pa.string())], ["start", "length", "text"])
        edits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), edits], names=["doc_id", "text", "edits"])


def with_cleaning_edits(docs: DataFrame) -> DataFrame:
    """doc_id, text and the edits that strip runs of signs and end the text with a line break."""
    return docs.select("doc_id", "text").mapInArrow(_cleaning, f"doc_id long, text string, edits {EDITS}")
