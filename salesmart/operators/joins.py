"""Joins against lookup tables that stay balanced when a few keys dominate."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import display_name

# A lookup is broadcast only after it was measured to be below both limits.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

HOT_KEYS_TRACKED = 10_000

# Rows of the larger side that one task of a keyed join and the sums on top of it gets.
PART_ROWS = 500_000


def measured_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and bytes in one distributed pass and tell whether both are within the limits."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns],
    )
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def dealt(frames: list[DataFrame], keys: list[str], rows: int) -> list[DataFrame]:
    """Frames dealt by the same keys to parts of about ``PART_ROWS`` rows, but to all cores at least.

    A task's memory then stays the same however many ``rows`` there are. Parts of a
    given size in bytes would hold too many narrow rows for the sums built on them.
    """
    parts = max(frames[0].sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PART_ROWS))
    return [df.repartition(parts, *keys) for df in frames]


def hot_keys(rows: DataFrame, keys: list[str], partitions: int) -> dict[int, int]:
    """Hashes of the keys that outgrow a partition, each with the parts it needs (one map-side pass).

    An even partition holds a ``partitions``-th of the rows. A key with more rows
    is split into parts of that size at most, so there are fewer such keys than
    partitions, and both limits move with the cluster's setting.
    """
    # Tracking far more items than are reported keeps the count error well below an even partition.
    tracked = min(max(partitions, 64), HOT_KEYS_TRACKED)
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(tracked), F.lit(tracked * 100))
    found = rows.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    even = max(1.0, found["n"] / partitions)
    return {i["item"]: math.ceil(i["count"] / even) for i in (found["top"] or []) if i["count"] > even}


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Attach the columns of ``lookup`` (one row per key) to ``rows``.

    A lookup measured to be small is broadcast. A larger one is shuffled; keys
    that outgrow one of ``partitions`` (the session's shuffle partitions) are
    then spread over as many parts as they fill and only their lookup rows are
    repeated. The part is a hash of the row, so that it stays the same when a
    task runs again; rows equal in all columns but maps share a part.
    """
    if measured_small(lookup, max_rows):
        return _joined(rows, F.broadcast(lookup), keys, how, null_safe)

    hot = hot_keys(rows, keys, partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not hot:
        return _joined(rows, lookup, keys, how, null_safe)

    by_hash = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    parts = F.coalesce(F.try_element_at(by_hash, F.xxhash64(*keys)), F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(rows)]), parts).cast("int")
    salted_rows = rows.withColumn("_salt", spread)
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return _joined(salted_rows, salted_lookup, [*keys, "_salt"], how, null_safe).drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition: Column = reduce(
        lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_shop(fact: DataFrame, shops: DataFrame) -> DataFrame:
    """Inner join on the shop id; adds ``shop_code`` and the display ``shop_name``."""
    names = shops.select(
        "shop_id", "shop_code", display_name(F.col("shop_name"), F.col("shop_code")).alias("shop_name")
    )
    return lookup_join(fact, names, ["shop_id"], how="inner")


def current_version(fact: DataFrame, staging: DataFrame, columns: list[str]) -> DataFrame:
    """Left join each fact row to the one staging row it was loaded from."""
    keys = ["import_file_id", "shop_id", "source_row_number", "sales_date"]
    return fact.join(staging.select(*keys, *columns), keys, "left")


def with_display_name(fact: DataFrame, names: DataFrame) -> DataFrame:
    keys = [
        "import_file_id",
        "shop_id",
        "sales_date",
        "product_id",
        "sku_id",
        "merchant_sku_code",
        "product_specification",
    ]
    return fact.join(names, keys, "left")


def lookup_by_code(dimension: DataFrame, column: str, code: str) -> DataFrame:
    return dimension.filter(F.col(column) == code)


def platform_id_of(platforms: DataFrame, code: str) -> int | None:
    """Id of one platform; the code is unique, so at most one row is read."""
    row = platforms.filter(F.col("platform_code") == code).select("platform_id").first()
    return None if row is None else row["platform_id"]


def resolve_shop(platforms: DataFrame, shops: DataFrame, platform_code: str, shop_code: str) -> DataFrame:
    """Platform and shop ids of one shop, found through both codes."""
    return (
        platforms.filter(F.col("platform_code") == platform_code)
        .join(shops.filter(F.col("shop_code") == shop_code), "platform_id")
        .select("platform_id", "shop_id", "platform_code", "shop_code")
    )
