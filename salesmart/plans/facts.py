"""Canonical facts from staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import key_text
from ..operators.merge import newest_import, upsert
from .staging import SHOP_DAY_FACT, SKU_MONEY, narrow_fact

IDENTITY = ["product_id", "sku_id", "merchant_sku_code", "product_specification"]
SHOP_DAY_KEYS = ["shop_id", "sales_date"]
SKU_DAY_KEYS = ["shop_id", "sales_date", *IDENTITY]


def fact_sku_day(staging: DataFrame) -> DataFrame:
    """Totals and row count per import and SKU-day identity; NULL identity parts become ''."""
    return staging.groupBy(
        "import_file_id", "shop_id", "sales_date", *[key_text(F.col(c)).alias(c) for c in IDENTITY]
    ).agg(
        *[F.sum(c).cast("decimal(14,2)").alias(c) for c in SKU_MONEY],
        F.count(F.lit(1)).cast("int").alias("source_row_count"),
    )


def sku_display_name(staging: DataFrame) -> DataFrame:
    """Greatest product name (byte order) per import and SKU-day identity."""
    return staging.groupBy(
        "import_file_id", "shop_id", "sales_date", *[key_text(F.col(c)).alias(c) for c in IDENTITY]
    ).agg(F.max("product_name").alias("product_name"))


def named_sku_day(staging: DataFrame) -> DataFrame:
    """Totals, row count and display name per import and SKU-day identity, from one aggregation."""
    return staging.groupBy(
        "import_file_id", "shop_id", "sales_date", *[key_text(F.col(c)).alias(c) for c in IDENTITY]
    ).agg(
        *[F.sum(c).cast("decimal(14,2)").alias(c) for c in SKU_MONEY],
        F.count(F.lit(1)).cast("int").alias("source_row_count"),
        F.max("product_name").alias("product_name"),
    )


def upsert_shop_day(fact: DataFrame, staging: DataFrame) -> DataFrame:
    """Apply one import's shop-day rows; a date repeated inside the import fails the job."""
    return upsert(fact, narrow_fact(staging), SHOP_DAY_KEYS, [*SHOP_DAY_FACT, "import_file_id", "source_row_number"])


def shop_day_facts(staging: DataFrame) -> DataFrame:
    """Canonical shop-day facts of all imports, newest import per key."""
    columns = [*SHOP_DAY_FACT, "import_file_id", "source_row_number"]
    return newest_import(narrow_fact(staging), SHOP_DAY_KEYS, columns, "import_file_id")


def sku_day_facts(staging: DataFrame) -> DataFrame:
    """Canonical SKU-day facts of all imports, newest import per key.

    The totals are already grouped by key and import, so the merge reuses their
    partitioning for its first step. Each fact carries the display name of the
    import it comes from, so views do not read staging again.
    """
    columns = [*SKU_MONEY, "import_file_id", "source_row_count", "product_name"]
    return newest_import(named_sku_day(staging), SKU_DAY_KEYS, columns, "import_file_id")


def upsert_sku_day(fact: DataFrame, totals: DataFrame) -> DataFrame:
    """Apply one import's SKU-day totals; they replace earlier totals, they do not add up."""
    return upsert(fact, totals, SKU_DAY_KEYS, [*SKU_MONEY, "import_file_id", "source_row_count"])
