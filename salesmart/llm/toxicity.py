"""Toxicity of whole texts: disguised words are restored by a noisy-channel decoder before they are scored."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm._shared import FOLD5, fold, keyed, text_views

#: Most labelled rows that the classifier is fitted on, taken in the order of a hash of their id.
TRAIN_ROWS = 12_000
#: Most features that the classifier keeps.
_MEMO = 300_000

#: What a sign may stand for, besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
_SIGNS = re.escape("".join(LEET))
_EDGES = ".,;:?!\"'()[]{}<>%&#*|~`^=/\\-_"
_PUNCTUATION = "".join(c for c in _EDGES if c not in LEET)
_LETTER, _SIGN = re.compile(r"[^\W\d_]"), re.compile(rf"[{_SIGNS}.*_\-]")
_DOUBLED = re.compile(rf"([^\W\d_])\1|[@$!|+€].*[@$!|+€]", re.DOTALL)
_ONE = r"[^\W_]|[@$!|+€]"
_SPACED = re.compile(rf"(?<![^\W_])(?<![@$|+€])(?:(?:{_ONE})[\s.\-_*]+){{3,}}(?:{_ONE})(?![^\W_@$|+€])(?![@$|+€])")
_GAPS = " .-_*\t\n\r\v\f"

_OTHER, SYMBOLS = 27, 28
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[0x41:0x5B] = _SYMBOL[0x61:0x7B] = np.arange(1, 27)
_SYMBOL[0x80:0xC0], _SYMBOL[0xC0:] = 255, _OTHER  # a character beyond ASCII counts once


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for body in text_views(batch.column("text")):
            for at in range(0, len(body), 1 << 20):  # three bytes of overlap at most are lost to a block's end
                s = _SYMBOL[body[at : at + (1 << 20)]]
                s = np.concatenate([[0], s[s != 255], [0]]).astype(np.int32)
                totals += np.bincount(s[:-2] * SYMBOLS * SYMBOLS + s[1:-1] * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(totals[seen])], names=["trigram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over 28 symbols, counted over all texts; at most 21,952 counts reach the driver."""
    counts = np.zeros(SYMBOLS**3)
    for r in keyed(docs).select("text").mapInArrow(_trigrams, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[r["trigram"]] = r["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pairs = counts.sum(0)
    backed = (pairs + 0.5) / (pairs.sum(1, keepdims=True) + 0.5 * SYMBOLS)
    return np.log((counts + 5 * backed) / (counts.sum(2, keepdims=True) + 5)).astype(np.float32)


def _of(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER if c.isalpha() else 0


#: What a boundary between two words costs at a gap.
_BOUNDARY = -3.0


def restore(token: str, model: list, split: bool = False) -> str:
    """The likeliest plain word behind ``token``: Viterbi over a lattice in which a sign may be itself, stand for a letter or
    be a filler, and a repeated letter may be dropped; with ``split`` a gap may also end a word. The character model weighs
    the paths."""
    paths: dict[tuple[int, int, str], tuple[float, tuple]] = {(0, 0, ""): (0.0, ())}
    for i, o in enumerate(token):
        ways: list[tuple[str, float]] = []
        gap = o in _GAPS or o.isspace()
        if o.isalpha():
            ways.append((o, 0.0))
            if i and token[i - 1] == o:
                ways.append(("", -0.7 if token[i - 2 : i] == o + o or token[i : i + 2] == o + o else -4.0))
        else:
            ways += [(c, -1.0) for c in LEET.get(o, "")]
            ways.append(("", -0.3 if gap else -9.0 if o in LEET else -5.0))
            if split and gap and i and token[i - 1] not in _GAPS:
                ways.append((" ", _BOUNDARY))
        further: dict[tuple[int, int, str], tuple[float, tuple]] = {}
        for (a, b, last), (score, text) in paths.items():
            for c, cost in ways:
                if c == " ":
                    key, value = (0, 0, ""), (score + cost + model[a][b][0], (text, c))
                elif c:
                    s = _of(c)
                    key, value = (b, s, c), (score + cost + model[a][b][s], (text, c))
                else:
                    key, value = (a, b, last), (score + cost, text)
                if key not in further or further[key][0] < value[0]:
                    further[key] = value
        paths = further
    _, text = max(((score + model[a][b][0], text) for (a, b, _), (score, text) in paths.items()), key=lambda p: p[0])
    letters = []
    while text:
        text, c = text
        letters.append(c)
    return "".join(reversed(letters))


class Restorer:
    """Restored words of a text; a memo of bounded size answers for words met before."""

    def __init__(self, model: np.ndarray):
        self.model, self.memo = model.tolist(), {}

    def word(self, token: str) -> str:
        """The reading in which signs at the edges are punctuation."""
        core = token.strip(_EDGES)
        core = core.rstrip("$") if core.endswith("$$") else core
        return self._restored(core)

    def _restored(self, core: str) -> str:
        suspect = (_SIGN.search(core) and _LETTER.search(core)) or _DOUBLED.search(core)
        return restore(core, self.model) if suspect else core

    def readings(self, token: str) -> set[str]:
        """The token as it stands and restored, with signs at its edges as punctuation and as letters."""
        core = token.strip(_EDGES)
        whole = token.strip(_PUNCTUATION)
        bare = core.rstrip("$") if core.endswith("$$") else core
        found = {core, bare}
        found |= {self._restored(x) for x in {whole, whole.rstrip("!|"), whole.lstrip("!|"), core, bare}}
        return found - {""}

    def words(self, text: str) -> list[str]:
        return [self.word(w) for w in set(text.split())] + self.spaced(text)

    def spaced(self, text: str) -> list[str]:
        return [restore(m.group().strip(_EDGES + " "), self.model) for m in _SPACED.finditer(text)]

    def spaced_readings(self, text: str) -> set[str]:
        """Words behind letters that stand apart: as one word, split by the lattice or at wider gaps, and without a word of
        one letter at either end."""
        found = set()
        for m in _SPACED.finditer(text):
            run = m.group()
            for part in {run, *re.split(r"\s{2,}", run)}:
                for x in {part, part.strip(_EDGES + " ")}:
                    inner = [re.sub(r"^\w[\s.\-_*]+", "", x), re.sub(r"[\s.\-_*]+\w$", "", x)]
                    found |= {restore(y, self.model) for y in (x, *inner)}
                    found.update(restore(x, self.model, split=True).split())
        return found - {""}


def _marks(word: str) -> list[str]:
    """A word and its beginnings, which stand for words of one stem."""
    return [word, *(word[:n] + "~" for n in (4, 5, 6) if len(word) > n)] if word else []


def _words_of(restorer: Restorer, lookup, memo: dict, text: str) -> set:
    low, found = text.lower(), set()
    for token in set(low.split()):
        marks = memo.get(token)
        if marks is None:
            if len(memo) >= _MEMO:
                memo.clear()
            marks = memo[token] = list({m for word in restorer.readings(token) for m in lookup(word)})
        found.update(marks)
    for word in restorer.spaced_readings(low):
        found.update(lookup(word))
    return found


def _features(shared):
    """Feature names of each text, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, memo = Restorer(shared.value), {}
        for batch in batches:
            found = [list(_words_of(restorer, _marks, memo, t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["toxic", "marks"])

    return run


def _rows(shared, score: bool):
    """Numbers of the known features of each text, or its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, index, weights, bias = shared.value
        restorer, memo = Restorer(model), {}
        known = lambda word: [index[m] for m in _marks(word) if m in index]
        for batch in batches:
            found = [_words_of(restorer, known, memo, t) for t in batch.column("text").to_pylist()]
            if score:
                values = [1 / (1 + np.exp(-(bias + sum(weights[i] for i in sorted(f))))) for f in found]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(values, pa.float64())], names=["doc_id", "text_key", "score"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([sorted(f) for f in found], pa.list_(pa.int32()))], names=["toxic", "marks"])

    return run


def _fit(rows: list, n_features: int) -> tuple[np.ndarray, float]:
    """Logistic regression on presence features, by full-batch adaptive gradient steps from zero."""
    y = np.array([r["toxic"] for r in rows], float)
    doc = np.repeat(np.arange(len(rows)), [len(r["marks"]) for r in rows])
    mark = np.array([m for r in rows for m in r["marks"]], np.int64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    w, bias = np.zeros(n_features), float(np.log(share / (1 - share)))
    seen, seen_b = np.full(n_features, 1e-8), 1e-8
    for _ in range(400):
        z = bias + np.bincount(doc, w[mark], len(y))
        off = 1 / (1 + np.exp(-z)) - y
        g, gb = np.bincount(mark, off[doc], n_features) + 0.05 * w, off.sum()
        seen, seen_b = seen + g * g, seen_b + gb * gb
        w, bias = w - 0.5 * g / np.sqrt(seen), bias - 0.5 * gb / np.sqrt(seen_b)
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple:
    """Character model over all texts and a classifier from at most ``train_rows`` labelled rows outside the held-out fold.

    The features (restored words and their first 4 to 6 letters) are those that mark toxic texts best; at most
    The marks of those texts that 3 toxic ones hold with a lift of 2, and ``train_rows`` short rows, reach the driver. Without labels of both kinds no feature is kept
    and every text gets the share of toxic labels (0 without labels)."""
    spark = docs.sparkSession
    model = character_model(docs)
    shared = spark.sparkContext.broadcast(model)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where((fold(F.col("doc_id"), FOLD5) != 0) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    sample = keyed(docs).join(F.broadcast(chosen), "doc_id").select("toxic", "text")  # bounded by train_rows
    counted = sample.mapInArrow(_features(shared), "toxic int, marks array<string>").select("toxic", F.explode("marks").alias("mark"))
    sizes = sample.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    bad, good = sizes["toxic"] or 0, sizes["n"] - (sizes["toxic"] or 0)
    if not bad or not good:
        return model, {}, np.zeros(0), (-745.0 if not bad else 745.0)
    with_, without = F.col("bad"), F.col("good")
    lift = F.log(((with_ + 0.5) / (bad + 1.0)) / ((without + 0.5) / (good + 1.0)))
    best = (
        counted.groupBy("mark")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where(with_ >= 3)
        .withColumn("lift", lift)
        .where("lift >= 2")
        .orderBy((F.col("bad") * F.col("lift")).desc(), "mark")
    )
    index = {r["mark"]: i for i, r in enumerate(best.collect())}  # bounded by the marks of train_rows texts
    known = spark.sparkContext.broadcast((model, index, None, 0.0))
    weights, bias = _fit(sample.mapInArrow(_rows(known, False), "toxic int, marks array<int>").collect(), len(index))
    return model, index, weights, bias


def score(docs: DataFrame, trained: tuple) -> DataFrame:
    """doc_id, text_key, score of every row; a text without words scores like one without marks."""
    model, index, weights, bias = trained
    shared = docs.sparkSession.sparkContext.broadcast((model, index, np.asarray(weights).tolist(), bias))
    return keyed(docs).mapInArrow(_rows(shared, True), "doc_id long, text_key long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns they came with."""
    bad = score(docs, train(docs if learn_from is None else learn_from, labels)).where(F.col("score") >= threshold)
    bad = bad.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__doc"]) & (key == bad["__key"]), "left_anti")
