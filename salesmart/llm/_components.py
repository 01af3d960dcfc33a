"""Connected components by contraction, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of ``edges`` (a, b of one orderable type).

    Each round points every node at its smallest neighbour or itself, follows that once more, and merges the edges; what is
    left shrinks by a factor each round, so chains take a logarithmic number of rounds. Hub nodes are joined by AQE's split
    joins, and grouping combines before it shuffles. Nothing but the question whether edges are left reaches the driver.
    """
    small = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = materialise(edges.where(F.col("a") != F.col("b")).select(*small).distinct())
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    first = True
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        parent = materialise(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")))
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("top"))
        jumped = materialise(parent.join(up, "p").select("u", "top"))
        if first:
            labels, first = jumped.select(F.col("u").alias("node"), F.col("top").alias("label")), False
        else:
            step = jumped.select(F.col("u").alias("label"), "top")
            labels = materialise(labels.join(step, "label", "left").select("node", F.coalesce("top", "label").alias("label")))
        to_a = jumped.select(F.col("u").alias("a"), F.col("top").alias("ta"))
        to_b = jumped.select(F.col("u").alias("b"), F.col("top").alias("tb"))
        merged = edges.join(to_a, "a").join(to_b, "b").where("ta != tb")
        edges = materialise(merged.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    return labels
