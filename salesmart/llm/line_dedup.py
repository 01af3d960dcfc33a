"""Lines that many documents share, dropped from all but one of them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import keyed
from salesmart.session import materialise

SPACE = b" \t\n\x0b\x0c\r"
DROP, PENDING, EDGE = 0, 1, 2
_LINES = "key_hi long, key_lo long, doc_id long, text_key long, pos int, n_lines int"
_DECIDED = "kind int, key_hi long, key_lo long, doc_id long, text_key long, pos int, n_lines int, n_docs long"


def _long_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text")), strict=True):
                lines = text.encode().lower().split(b"\n")  # bytes.lower() folds A-Z alone
                for pos, line in enumerate(lines):
                    line = line.strip(SPACE)
                    if len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode()) >= min_chars):
                        h = xxhash.xxh3_128_intdigest(line)
                        out.append(((h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), doc, key, pos, len(lines)))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                names = ["key_hi", "key_lo", "doc_id", "text_key", "pos", "n_lines"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def _stream(min_docs: int):
    """Walk one sorted range. The first document of a key keeps it; the lines of the others are held until the key is known
    to have enough documents, which takes the lines of fewer than ``min_docs`` documents. The first key may have begun in
    the range before and the last may go on in the next: what they leave open is settled through the edge rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = doc = None
        docs, first_key, largest = 0, True, None
        held: list[tuple] = []
        for frame in frames:
            out: list[tuple] = []
            for hi, lo, d, text_key, pos, n in zip(*(frame[c].tolist() for c in frame.columns), strict=True):
                if (hi, lo) != key:
                    if key is not None and first_key:
                        out.append((EDGE, *key, largest, 0, 0, 0, docs))
                    first_key = key is None
                    key, doc, docs, largest, held = (hi, lo), None, 0, d, []
                if d != doc:
                    doc, docs = d, docs + 1
                    if docs == min_docs and not first_key:
                        out += [(DROP, *x) for x in held]
                        held = []
                if first_key:
                    out.append((PENDING, hi, lo, d, text_key, pos, n, 0))
                elif docs >= min_docs:
                    out.append((DROP, hi, lo, d, text_key, pos, n, 0))
                elif d != largest:
                    held.append((hi, lo, d, text_key, pos, n, 0))
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)
        if key is not None:
            yield pd.DataFrame([(PENDING, *x) for x in held] + [(EDGE, *key, largest, 0, 0, 0, docs)], columns=_COLUMNS)

    return run


_COLUMNS = [x.split()[0] for x in _DECIDED.split(", ")]


def _bitmap(positions: pd.Series, n_lines: pd.Series) -> pd.Series:
    def one(drops, n):
        keep = np.ones(n, bool)
        keep[np.asarray(drops, np.int64)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(p, n) for p, n in zip(positions, n_lines, strict=True)], dtype=object)


def kept_lines(text: str, bitmap: bytes | None) -> tuple[str, int, int]:
    """The text without its dropped lines, and the number of lines before and dropped."""
    lines = text.split("\n")
    if bitmap is None:
        return text, len(lines), 0
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join(x for x, k in zip(lines, keep, strict=True) if k), len(lines), len(lines) - int(keep.sum())


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Compressed keep bitmaps (doc_id, text_key, bitmap) of the rows of ``docs`` that lose a line; the others keep all.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. A key of at least
    ``min_chars`` code points that occurs in at least ``min_docs`` documents loses its lines except in the largest doc_id.
    Text never moves: only hashes, ids and positions are range-partitioned by (hash, document) and sorted by document and
    position, so one key held by a third of all lines is spread over many ranges. Each range reports at most two open keys;
    that table of two rows per partition is what is broadcast.

    Empty tables give no rows; rows without doc_id are never changed; repeated rows (doc_id and text) count once and get
    equal bitmaps; a line repeated inside the keeping document stays each time.
    """
    lines = keyed(docs).where("doc_id IS NOT NULL").mapInArrow(_long_lines(min_chars), _LINES)
    order = [F.col("key_hi"), F.col("key_lo"), F.col("doc_id").desc()]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_key", "pos")
    decided = materialise(ranged.mapInPandas(_stream(min_docs), _DECIDED))
    edges = (
        decided.where(F.col("kind") == EDGE)
        .groupBy("key_hi", "key_lo")
        .agg(F.sum("n_docs").alias("all_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("all_docs") >= min_docs)
    )
    settled = decided.where(F.col("kind") == PENDING).join(F.broadcast(edges), ["key_hi", "key_lo"]).where("doc_id != keeper")
    columns = ["doc_id", "text_key", "pos", "n_lines"]
    drops = decided.where(F.col("kind") == DROP).select(columns).unionByName(settled.select(columns))
    pack = F.pandas_udf(_bitmap, "binary")
    return (
        drops.groupBy("doc_id", "text_key", "n_lines")
        .agg(F.collect_set("pos").alias("positions"))
        .select("doc_id", "text_key", pack("positions", "n_lines").alias("bitmap"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the kept text in ``text`` and the columns n_lines and n_dropped (replaced where they exist)."""
    bitmaps = line_bitmaps(docs, min_chars, min_docs)
    body = F.coalesce(F.col("text"), F.lit(""))
    left = docs.drop("n_lines", "n_dropped").withColumn("__key", F.xxhash64(body))
    marks = bitmaps.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__mark"), F.col("bitmap").alias("__bitmap"))
    joined = left.join(marks, (left["doc_id"] == marks["__doc"]) & (left["__key"] == marks["__mark"]), "left")

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def cut(text: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([kept_lines(t, b) for t, b in zip(text, bitmap, strict=True)], columns=["text", "n_lines", "n_dropped"])

    done = joined.withColumn("__cut", F.when(F.col("__bitmap").isNotNull(), cut(body, F.col("__bitmap"))))
    whole = F.size(F.split(body, "\n", -1)).cast("long")
    return done.select(
        *[
            F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.col("__cut.text")).alias("text") if c == "text" else F.col(f"`{c}`")
            for c in left.columns
            if c != "__key"
        ],
        F.coalesce(F.col("__cut.n_lines"), whole).alias("n_lines"),
        F.coalesce(F.col("__cut.n_dropped"), F.lit(0).cast("long")).alias("n_dropped"),
    )

