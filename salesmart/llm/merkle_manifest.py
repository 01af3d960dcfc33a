"""A Merkle manifest of a table: one tree for each language, a tree over their roots, and octopus multiproofs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.session import materialise

ARITY = 8
#: Levels that one group of leaves derives by itself: it has 8**4 leaves.
LEVELS = 4
#: The tree over the subroots; trees of languages are named by the encoded language, which is never empty.
TOP = ""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, level int, idx long, digest string"
_PROOF = (
    "row_id long, lang string, position long, n_leaves long, leaf string, presented string, subroot string, root string, "
    "siblings string, steps array<struct<place:int,width:int>>"
)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row of documents, with some columns changed."""
    return F.sha2(F.concat(*[encoded(changed.get(c, F.col(f"`{c}`"))) for c in FIELDS]).cast("binary"), 256)


def _h(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above ``n`` leaves; a lone leaf is its own root."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


# --- positions ---------------------------------------------------------------------------------------------------------


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a sorted partition within each tree."""
    part, tree, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        numbers = []
        for name in batch.column("tree").to_pylist():
            if name != tree:
                tree, n = name, 0
            numbers.append(n)
            n += 1
        added = [pa.array([part] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "part", "number"])


def _positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their position and the number of rows in their tree; ``order`` begins with what orders the trees.

    Rows are range-partitioned, so a tree of any size is spread over many tasks; the numbers in the ranges are written down
    before the offsets of the ranges, a small table of one row per range and tree, are added."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ranged.mapInArrow(_numbered, f"{_ddl(rows)}, part int, number long"))
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = W.partitionBy("tree").orderBy("part")
    before = F.coalesce(F.sum("n").over(parts.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("tree", "part", before.alias("offset"), F.sum("n").over(W.partitionBy("tree")).alias("n_leaves"))
    joined = placed.join(offsets, ["tree", "part"])
    return joined.select(*rows.columns, (F.col("offset") + F.col("number")).alias("position"), "n_leaves")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


# --- nodes -------------------------------------------------------------------------------------------------------------


def _chunk(position: str, levels: int) -> Column:
    return F.shiftright(position, 3 * levels).alias("chunk")


def _interior(level: int, levels: int):
    """The nodes that one chunk of consecutive nodes of ``level`` has above it, as far as it derives them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, total, first = table.column("tree")[0].as_py(), table.column("n_leaves")[0].as_py(), table.column("idx")[0].as_py()
        digests, out = table.column("digest").to_pylist(), []
        for up in range(level + 1, min(level + levels, depth(total)) + 1):
            first //= ARITY
            digests = [_h(digests[i : i + ARITY]) for i in range(0, len(digests), ARITY)]
            out += [(tree, up, first + i, d, total) for i, d in enumerate(digests)]
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "level", "idx", "digest", "n_leaves"])

    return run


def _nodes(leaves: DataFrame, levels: int) -> DataFrame:
    """All nodes above leaves (tree, idx, digest, n_leaves), some levels at a time: a group has 4,096 nodes at most, however
    large a tree is, and each round has one node left for each of them."""
    largest = leaves.agg(F.max("n_leaves")).first()[0] or 0
    rounds, below = [], leaves.select("tree", F.col("idx").alias("idx"), "digest", "n_leaves")
    for level in range(0, depth(largest), levels):
        grouped = below.groupBy("tree", _chunk("idx", levels))
        made = materialise(grouped.applyInArrow(_interior(level, levels), f"{_NODE}, n_leaves long"))
        rounds.append(made)
        below = made.where(F.col("level") == level + levels).select("tree", "idx", "digest", "n_leaves")
    out = leaves.sparkSession.createDataFrame([], f"{_NODE}, n_leaves long")
    for made in rounds:
        out = out.unionByName(made)
    return out


class Manifest:
    """leaves: row_id, lang, tree, position, n_leaves, leaf, presented, top, n_trees (the place of the tree's root among all).
    nodes: tree, level, idx, digest of all nodes that are no leaves of a language; those of the top tree include its leaves.
    Both are written tables."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame, root: str | None):
        self.leaves, self.nodes, self.root = leaves, nodes, root


def build(docs: DataFrame, presented: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of a table with the columns of documents; other columns are not read. ``presented`` is the digest that
    each row will show when its proof is checked, such as that of a changed version; its own leaf, if not given.

    Within a language leaves ascend by doc_id, nulls first, rows of one id by their digest (equal rows are equal leaves,
    each of which counts). Null languages come first, the others follow in the order of their bytes. An empty table has no
    root. Texts are read once and never shuffled."""
    lang = F.col("lang").cast("string")
    shown = leaf_digest() if presented is None else presented
    rows = docs.select(
        F.col("doc_id").cast("long").alias("row_id"), lang.alias("lang"), encoded(lang).alias("tree"), leaf_digest().alias("leaf"), shown.alias("presented")
    )
    order = [F.col(c).asc_nulls_first() for c in ("lang", "row_id", "leaf")]
    placed = materialise(_positions(materialise(rows), order))  # digests are written before they are sorted: sorting samples them
    inner = _nodes(placed.select("tree", F.col("position").alias("idx"), F.col("leaf").alias("digest"), "n_leaves"), levels)
    lone = placed.where("n_leaves = 1").select("tree", "lang", F.col("leaf").alias("digest"))
    langs = placed.where("position = 0 AND n_leaves > 1").select("tree", "lang")
    tops = inner.where("idx = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))  # the highest level has one node
    subroots = langs.join(tops, "tree").select("tree", "lang", "digest").unionByName(lone)
    named = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "lang", "digest")
    top = materialise(_positions(named, [F.col("lang").asc_nulls_first()]))
    above = _nodes(top.select("tree", F.col("position").alias("idx"), "digest", "n_leaves"), levels)
    zero = top.select("tree", F.lit(0).alias("level"), F.col("position").alias("idx"), "digest")
    columns = ["tree", "level", "idx", "digest"]
    nodes = inner.select(columns).unionByName(above.select(columns)).unionByName(zero)
    found = nodes.where((F.col("tree") == TOP) & (F.col("idx") == 0)).agg(F.max_by("digest", "level")).first()[0]
    places = top.select(F.col("of").alias("tree"), F.col("position").alias("top"), F.col("n_leaves").alias("n_trees"))
    return Manifest(placed.join(places, "tree"), nodes, found)


# --- proofs ------------------------------------------------------------------------------------------------------------


def missing_nodes(known: set[int], n_leaves: int) -> list[tuple[int, int]]:
    """The least set of (level, idx) that, with the leaves ``known``, gives the root: at each level the members of the groups
    of known nodes that are not known themselves."""
    out, level, width = [], 0, n_leaves
    while width > 1:
        groups = {i // ARITY for i in known}
        for g in sorted(groups):
            out += [(level, i) for i in range(g * ARITY, min(width, (g + 1) * ARITY)) if i not in known]
        known, width, level = groups, -(-width // ARITY), level + 1
    return out


def _wanted(table: pa.Table) -> pa.Table:
    """Coordinates of the nodes that a chunk of leaves lacks: in the tree of its language, and in the tree over all."""
    tree, chunk = table.column("tree")[0].as_py(), table.column("chunk")[0].as_py()
    total, top, trees = (table.column(c)[0].as_py() for c in ("n_leaves", "top", "n_trees"))
    out = [(tree, *x) for x in missing_nodes(set(table.column("position").to_pylist()), total)]
    out += [(TOP, *x) for x in missing_nodes({top}, trees)]
    columns = list(zip(*out, strict=True)) if out else [()] * 3
    return pa.table(
        [pa.array([tree] * len(out), pa.string()), pa.array([chunk] * len(out), pa.int64()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
        names=["for_tree", "chunk", "tree", "level", "idx"],
    )


def _filled(levels: list[dict[int, str]], n_leaves: int) -> str:
    """Derive the interiors that the known nodes share, level by level, and return the root."""
    width, level = n_leaves, 0
    while width > 1:
        here, up = levels[level], levels[level + 1]
        for g in sorted({i // ARITY for i in here}):
            group = range(g * ARITY, min(width, (g + 1) * ARITY))
            if g not in up and all(i in here for i in group):
                up[g] = _h([here[i] for i in group])
        width, level = -(-width // ARITY), level + 1
    return levels[level][0]


def _path(levels: list[dict[int, str]], position: int, n_leaves: int) -> tuple[list[str], list[tuple[int, int]]]:
    siblings, steps, width, level = [], [], n_leaves, 0
    while width > 1:
        g = position // ARITY
        group = range(g * ARITY, min(width, (g + 1) * ARITY))
        siblings += [levels[level][i] for i in group if i != position]
        steps.append((position - g * ARITY, len(group)))
        position, width, level = g, -(-width // ARITY), level + 1
    return siblings, steps


def _expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
    """The proof of each leaf of a chunk, from its leaves and the nodes that were fetched for it once."""
    rows = leaves.to_pylist()
    if not rows:
        return pa.table({f.name: pa.array([], f.type) for f in _PROOF_ARROW}, schema=_PROOF_ARROW)
    total, top, trees = (rows[0][c] for c in ("n_leaves", "top", "n_trees"))
    own: list[dict[int, str]] = [{} for _ in range(depth(total) + 1)]
    over: list[dict[int, str]] = [{} for _ in range(depth(trees) + 1)]
    for tree, level, idx, digest in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")), strict=True):
        (over if tree == TOP else own)[level][idx] = digest
    for r in rows:
        own[0][r["position"]] = r["leaf"]
    subroot = _filled(own, total)
    over[0][top] = subroot
    root = _filled(over, trees)
    above, above_steps = _path(over, top, trees)
    out = {f.name: [] for f in _PROOF_ARROW}
    for r in rows:
        siblings, steps = _path(own, r["position"], total)
        values = (r["row_id"], r["lang"], r["position"], total, r["leaf"], r["presented"], subroot, root, "".join(siblings + above), steps + above_steps)
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)
    out["steps"] = [[{"place": p, "width": w} for p, w in steps] for steps in out["steps"]]
    return pa.table({f.name: pa.array(out[f.name], f.type) for f in _PROOF_ARROW}, schema=_PROOF_ARROW)


_PROOF_ARROW = pa.schema(
    [
        ("row_id", pa.int64()),
        ("lang", pa.string()),
        ("position", pa.int64()),
        ("n_leaves", pa.int64()),
        ("leaf", pa.string()),
        ("presented", pa.string()),
        ("subroot", pa.string()),
        ("root", pa.string()),
        ("siblings", pa.string()),
        ("steps", pa.list_(pa.struct([("place", pa.int32()), ("width", pa.int32())]))),
    ]
)


def prove(manifest: Manifest, leaves: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """Proofs of ``leaves`` (rows of ``manifest.leaves``; all of them if not given): row_id, lang, position, n_leaves, leaf,
    presented, subroot, root, siblings (the digests of all siblings as hex text, level by level via the subroot to the root, left to
    right), steps (the place and width of each group).

    Leaves are taken in chunks of at most 4,096 consecutive positions of a tree, so a large language is many groups. Each
    chunk asks once for the nodes it lacks (of all leaves, a few dozen above its own subtree), derives the nodes its leaves
    share once, and expands the single proofs from them."""
    wanted = (manifest.leaves if leaves is None else leaves).withColumn("chunk", _chunk("position", levels))
    asked = wanted.groupBy("tree", "chunk").applyInArrow(_wanted, "for_tree string, chunk long, tree string, level int, idx long")
    nodes = manifest.nodes
    if leaves is not None:  # neighbours of single leaves can be leaves themselves
        zero = manifest.leaves.select("tree", F.lit(0).alias("level"), F.col("position").alias("idx"), F.col("leaf").alias("digest"))
        nodes = nodes.unionByName(zero)
    fetched = asked.join(nodes, ["tree", "level", "idx"]).select("for_tree", "chunk", "tree", "level", "idx", "digest")
    return wanted.groupBy("tree", "chunk").cogroup(fetched.groupBy("for_tree", "chunk")).applyInArrow(_expand, _PROOF)


def fold(presented: str, siblings: str, steps: list[tuple[int, int]]) -> str:
    """The root that a leaf and its siblings give."""
    at = 0
    for place, width in steps:
        group = [siblings[at + 64 * i : at + 64 * (i + 1)] for i in range(width - 1)]
        at += 64 * (width - 1)
        group.insert(place, presented)
        presented = _h(group)
    return presented


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        steps = batch.column("steps")
        bounds = steps.offsets.to_pylist()
        pairs = list(zip(steps.values.field("place").to_pylist(), steps.values.field("width").to_pylist(), strict=True))
        rows = zip(batch.column("presented").to_pylist(), batch.column("siblings").to_pylist(), bounds[:-1], bounds[1:], strict=True)
        folded = [fold(leaf, siblings, pairs[a:b]) for leaf, siblings, a, b in rows]
        rest = batch.drop_columns(["siblings", "steps"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(folded, pa.string())], names=[*rest.schema.names, "folded_root"])


def verify(proofs: DataFrame) -> DataFrame:
    """``proofs`` without siblings and steps, with folded_root (what the presented digest and the siblings give) and verified
    (it is the root). Every proof is folded by itself."""
    rest = proofs.drop("siblings", "steps")
    done = proofs.mapInArrow(_verify, f"{_ddl(rest)}, folded_root string")
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
