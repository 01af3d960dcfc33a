"""Token budgets through a tree of groups, and the rows that fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.session import materialise

ROWS_PER_BUCKET = 10_000
_WORD = r"[^\x20\x09-\x0D]+"


def _n_words(text: Column) -> Column:
    """Words of a text: each becomes one letter and the rest goes, so a long text never turns into an array of its words."""
    letters = F.translate(F.regexp_replace(text, _WORD, "x"), " \t\n\x0b\f\r", "")
    return F.length(letters).cast("long")


def _weight(level: int, weights: list[dict[str, float]]) -> Column:
    """The weight of a node among its siblings; 1 unless it is named."""
    value = F.lit(1.0)
    for name, w in (weights[level] if level < len(weights) else {}).items():
        value = F.when(F.col(f"l{level}") == name, F.lit(float(w))).otherwise(value)
    return value


def leaf_budgets(leaves: DataFrame, depth: int, weights: list[dict[str, float]], share: float, max_epochs: int) -> DataFrame:
    """l0.. and the budget of each leaf, from its ``tokens``.

    A leaf can give ``max_epochs`` times its tokens, an inner node what its children can. From the root down each node's
    budget is dealt to its children by weight; a child that cannot take its part is filled and the rest is dealt among its
    siblings. What a whole family cannot take was never dealt to it, but to its parent's siblings. Budgets are rounded down
    to whole tokens. The tables are as long as there are groups; no row of text is touched."""
    path = [f"l{i}" for i in range(depth)]
    nodes = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    budget = nodes.groupBy().agg(F.floor(F.sum("tokens") * F.lit(share)).alias("asked"), F.sum("capacity").alias("can"))
    budget = budget.select(F.least("asked", "can").cast("double").alias("budget"))
    for level in range(depth):
        keys, parents = path[: level + 1], path[:level]
        children = nodes.groupBy(*keys).agg(F.sum("capacity").cast("double").alias("c")).withColumn("w", _weight(level, weights))
        children = children.join(budget, parents) if parents else children.join(F.broadcast(budget))  # the root is one row
        family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        order = family.orderBy(F.when(F.col("w") > 0, F.col("c") / F.col("w")), *keys).rowsBetween(Window.unboundedPreceding, -1)
        filled = F.col("c") * (F.sum("w").over(family) - F.coalesce(F.sum("w").over(order), F.lit(0.0))) <= F.col("w") * (
            F.col("budget") - F.coalesce(F.sum("c").over(order), F.lit(0.0))
        )
        children = children.withColumn("full", filled)
        left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("c")).otherwise(0.0)).over(family)
        claims = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(family)
        given = F.when(F.col("full"), F.col("c")).when(claims > 0, F.least(F.col("c"), F.floor(F.col("w") * left / claims).cast("double"))).otherwise(0.0)
        budget = children.select(*keys, F.greatest(given, F.lit(0.0)).alias("budget"))
    return budget.select(*path, F.col("budget").cast("long").alias("budget"))


def mix(docs: DataFrame, levels: list[Column], weights: list[dict[str, float]], share: float = 0.5, max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Rows of ``docs`` with l0.. (the groups), n_tokens and epoch, each as often as it was selected.

    Tokens are runs without ASCII white space. A leaf whose budget exceeds its tokens is repeated whole; of the last epoch
    it gives the longest prefix, in the order of a seeded hash of epoch and row, that fits. That order is dealt into buckets
    of about 10,000 rows by ranges of the hash: sums of buckets find the one in which the budget ends, and only that one is
    sorted, so a leaf with a third of all rows is never one task's work.

    Twins (rows with one doc_id, also none, one text and one group) stand side by side and each counts. They are counted
    before anything is sorted, so any number of them is one entry; where the budget ends among twins, as many as fit get the
    turn, whichever they are.

    A null group counts as the group "none"; empty texts have no tokens and come along wherever they fall into the prefix;
    an empty table gives no rows. Columns named l0.., n_tokens and epoch are replaced; others keep name and value.
    """
    depth = len(levels)
    path = [f"l{i}" for i in range(depth)]
    own = [c for c in docs.columns if c not in {*path, "n_tokens", "epoch"}]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        *[F.coalesce(level.cast("string"), F.lit("none")).alias(p) for level, p in zip(levels, path, strict=True)],
        _n_words(F.coalesce("text", F.lit(""))).alias("n_tokens"),
    )
    twin = ["doc_id", "key", *path, "n_tokens"]
    slim = rows.select(F.col("own.doc_id").alias("doc_id"), *twin[1:])
    twins = materialise(slim.groupBy(*twin).agg(F.count("*").alias("n_twins")).withColumn("t", F.col("n_tokens") * F.col("n_twins")))
    leaves = twins.groupBy(*path).agg(F.sum("t").alias("tokens"), F.sum("n_twins").alias("n_rows"))
    plan = leaves.join(leaf_budgets(leaves, depth, weights, share, max_epochs), path)
    plan = plan.withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")).withColumn("buckets", F.ceil(F.col("n_rows") / ROWS_PER_BUCKET))
    plan = materialise(plan.select(*path, "whole", "rest", "buckets"))
    placed = twins.join(plan, path).withColumn("at", F.xxhash64(F.lit(seed), F.col("whole"), F.col("doc_id"), F.col("key")))
    placed = placed.withColumn("bucket", F.floor((F.col("at") / F.lit(2.0**64) + 0.5) * F.col("buckets")).cast("long"))
    sums = placed.groupBy(*path, "rest", "bucket").agg(F.sum("t").alias("t"))
    before = Window.partitionBy(*path).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0).cast("long")))
    sums = materialise(sums.where(F.col("before") <= F.col("rest")).select(*path, "bucket", "before", (F.col("before") + F.col("t") <= F.col("rest")).alias("fits")))
    met = placed.join(sums, [*path, "bucket"])
    inside = Window.partitionBy(*path, "bucket").orderBy("at", "doc_id", "key").rowsBetween(Window.unboundedPreceding, 0)
    edge = met.where("NOT fits").withColumn("upto", F.col("before") + F.sum("t").over(inside)).where("upto - t <= rest")
    fit = F.when(F.col("upto") <= F.col("rest"), F.col("n_twins")).otherwise(F.floor((F.col("rest") - F.col("upto") + F.col("t")) / F.col("n_tokens")))
    taken = [*twin[:-1], "n_twins", "n_last"]
    last = met.where("fits").withColumn("n_last", F.col("n_twins")).select(taken).unionByName(edge.withColumn("n_last", fit.cast("long")).select(taken))
    last = materialise(last.where("n_last > 0"))
    halves = last.where("n_last < n_twins")  # at most one group of equal rows for each leaf: where its budget ends

    def matched(part: DataFrame, how: str) -> DataFrame:
        named = part.select(F.struct(*taken).alias("found"))
        same = F.col("own.doc_id").eqNullSafe(F.col("found.doc_id"))
        for c in twin[1:-1]:
            same = same & (F.col(c) == F.col(f"found.{c}"))
        return rows.join(plan.select(*path, "whole"), path).join(named, same, how)

    some = F.coalesce(F.col("found.n_last"), F.lit(0))
    turns = F.col("whole") + (some > 0).cast("int")
    if halves.isEmpty():
        done = matched(last, "left")
    else:
        done = matched(last, "left").where((some == 0) | (some == F.col("found.n_twins"))).withColumn("turns", turns)
        cut = _numbered(matched(halves, "inner"), twin[:-1])
        done = done.unionByName(cut.withColumn("turns", F.col("whole") + (F.col("number") <= some).cast("int")).select(done.columns))
        turns = F.col("turns")
    epochs = F.explode(F.sequence(F.lit(0), turns - 1)).alias("epoch")
    return done.where(turns > 0).select(*[F.col("own")[c].alias(c) for c in own], *path, "n_tokens", epochs)


def _numbered(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows numbered from 1 within their groups of twins. They are written first, so that numbers stay; each written part
    numbers its own rows of a group, after those of the parts before it."""
    keys = [f"found.{c}" for c in group]
    kept = materialise(rows.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)))
    inside = Window.partitionBy(*keys, "part").orderBy("id")
    counts = kept.groupBy(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)], "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*[f"g{i}" for i in range(len(keys))]).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumnRenamed("part", "of")
    same = F.col("part") == F.col("of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"g{i}"))
    local = kept.withColumn("local", F.row_number().over(inside))
    return local.join(starts, same).withColumn("number", F.col("start") + F.col("local"))


def source_domain(source: str = "source") -> Column:
    """Domains of the test tables' sources: the source's number modulo 4."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"(\d+)$", 1)
    return F.concat(F.lit("domain"), F.when(number == "", "none").otherwise((number.cast("long") % 4).cast("string")))


#: Weights of the domains and of the languages inside a domain; sources of a language weigh the same.
DOMAIN_WEIGHTS = {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0}
LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}


def mix_documents(docs: DataFrame) -> DataFrame:
    levels = [source_domain(), F.col("lang"), F.col("source")]
    return mix(docs, levels, [DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS])
