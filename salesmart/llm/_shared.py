"""Helpers shared by the operators of this subpackage.

Rules that hold for every operator on documents, unless its docstring says otherwise:

* A row is identified by (doc_id, hash of its text). Rows that repeat both are one document and get equal results; every
  row is returned. Rows with one doc_id and different texts are separate rows of the same document.
* A row without doc_id takes no part in comparisons between documents; it is returned as if it stood alone.
* A null text counts as an empty text. Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
MASK63 = (1 << 63) - 1
BLOCK = 1 << 20
FOLD5, FOLD7 = 5, 7


def keyed(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (never null) and text_key, the hash that tells rows of one doc_id apart."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_key"))


def fold(doc: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; an id that is null falls into no fold."""
    return F.crc32(doc.cast("string").cast("binary")) % parts


def text_views(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each value as a read-only view, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    absent = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield body[:0] if absent is not None and absent[i] else body[ends[i] : ends[i + 1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 1 << 62)) * 8 + 5  # odd, and no power of it is close to 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BASE &= (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the hash base and of its inverse, as many as were needed so far."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return cls.up, cls.down


def _lowered(values: np.ndarray) -> np.ndarray:
    values = values.copy()
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


#: Words are runs of bytes that are no ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of ASCII letters, digits and all non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLDED = _lowered(BYTE_VALUES)


def word_bounds(body: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offset of each word."""
    flags = np.zeros(len(body) + 2, np.int8)
    flags[1:-1] = inside[body]
    steps = np.diff(flags)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(body: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased, in order; works through long texts in blocks."""
    parts, at = [], 0
    while at < len(body):
        end = min(len(body), at + BLOCK)
        while end < len(body) and inside[body[end]]:  # a block ends between words
            end += 1
        piece = body[at:end]
        starts, stops = word_bounds(piece, inside)
        if len(starts):
            up, down = _Powers.of(len(piece) + 1)
            values = np.where(inside, _FOLDED, U64(0))[piece]
            values *= up[: len(piece)]
            parts.append(mix(np.add.reduceat(values, starts) * down[starts] + (stops - starts).astype(U64)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, U64)


_STEPS = [U64(int(x)) for x in _rng.integers(1, 1 << 62, 64) * 2 + 1]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; of fewer words, the whole sequence as one."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    total = np.full(n, U64(width), U64)
    for i in range(width):
        total *= _STEPS[0]
        total += words[i : i + n]
        total ^= total >> U64(29)
    return mix(total)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
