"""Dense ranks that do not need one task per group or for the whole table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .joins import BROADCAST_ROWS, lookup_join

# Up to this many rows a plain window is cheaper and one task holds them easily.
SINGLE_TASK_ROWS = 200_000

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


@dataclass(frozen=True)
class Order:
    """One sort key: descending puts NULL first, ascending puts NULL last."""

    column: str
    descending: bool = False

    def expr(self) -> Column:
        c = F.col(f"`{self.column}`")
        return c.desc_nulls_first() if self.descending else c.asc_nulls_last()


@dataclass(frozen=True)
class Rank:
    name: str
    order: tuple[Order, ...]
    partition: tuple[str, ...] = ()


def dense_ranks(
    df: DataFrame,
    ranks: list[Rank],
    single_task_rows: int = SINGLE_TASK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add dense ranks to ``df``, which is written once and counted from the file footers.

    Few rows get plain windows. More rows are ranked through their distinct
    keys, so neither one group nor the whole table ends up in one task.
    """
    rows = materialise(df)
    if rows.count() <= single_task_rows:
        for rank in ranks:
            window = W.partitionBy(*rank.partition).orderBy(*[o.expr() for o in rank.order])
            rows = rows.withColumn(rank.name, F.dense_rank().over(window))
        return rows
    for rank in ranks:
        keys = [*rank.partition, *[o.column for o in rank.order]]
        rows = lookup_join(rows, _ranked_keys(rows, rank, broadcast_rows), keys, "left", True, broadcast_rows)
    return rows


def _ranked_keys(rows: DataFrame, rank: Rank, broadcast_rows: int) -> DataFrame:
    """One row per distinct (partition, order) key with its dense rank.

    Distinct keys are range-partitioned and sorted, so their position counts the
    distinct values before them. The positions are written down before they are
    used: a repeated task could otherwise number them differently.
    """
    keys = [*rank.partition, *[o.column for o in rank.order]]
    sort = [*[F.col(p).asc_nulls_last() for p in rank.partition], *[o.expr() for o in rank.order]]
    placed = materialise(
        rows.select(*keys)
        .distinct()
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_position", _POSITION_BITS))
    )
    # One row per shuffle partition: bounded by the partition count, not by the data.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    indexed = placed.join(F.broadcast(starts), "_part").withColumn("_index", F.col("_start") + local)
    if not rank.partition:
        return indexed.select(*keys, (F.col("_index") + 1).cast("int").alias(rank.name))
    # Sorted by partition first, so a partition's ranks count from its first index.
    firsts = indexed.groupBy(*rank.partition).agg(F.min("_index").alias("_first"))
    joined = lookup_join(indexed, firsts, list(rank.partition), "left", True, broadcast_rows)
    return joined.select(*keys, (F.col("_index") - F.col("_first") + 1).cast("int").alias(rank.name))


def row_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Consecutive numbers from 1 in the order of a unique key, without a single-task window."""
    return dense_ranks(df, [Rank(name, tuple(Order(c) for c in order))])
