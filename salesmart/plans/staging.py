"""Raw rows -> typed staging, and the backfill of the layers from a wide fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import SHOP_DAILY_LOAD, SKU_DAILY_LOAD, Contract
from ..functions import clean_excel_date, floor_int, money, rate, repair_number, strip
from ..operators.joins import lookup_join

SHOP_DAY_COUNTS = [
    "shop_visitor_count",
    "shop_pageview_count",
    "product_visitor_count",
    "product_pageview_count",
    "buyer_count",
    "order_count",
    "product_favorite_user_count",
]
SHOP_DAY_MONEY = ["gross_sales_amount", "avg_order_value", "uv_value", "refund_amount"]
SKU_MONEY = ["gross_quantity", "gross_product_amount", "merchant_net_amount"]
SKU_TEXT = ["product_name", "product_id", "merchant_sku_code", "product_specification", "sku_id"]
SHOP_DAY_FACT = ["buyer_count", "order_count", "gross_sales_amount", "refund_amount"]


def contract_texts(raw: DataFrame, contract: Contract) -> DataFrame:
    """Add one text column per field: first non-blank accepted header of the row.

    Lookup, trim and choice are separate projections, so no text is read or
    trimmed twice by the expressions built on top of it.
    """
    headers = [(f"_{i}_{j}", f, h) for i, f in enumerate(contract.fields) for j, h in enumerate(f.headers)]
    trimmed = raw.withColumns({c: strip(F.try_element_at("raw_payload", F.lit(h))) for c, _, h in headers})
    chosen = {
        f.name: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c, g, _ in headers if g is f]) for f in contract.fields
    }
    return trimmed.withColumns(chosen)


def scope_import(raw: DataFrame, import_file_id: int, sheet_name: str) -> DataFrame:
    """Rows of one import and one sheet; the import id is the partition column of the layer."""
    return raw.filter((F.col("import_file_id") == import_file_id) & (F.col("sheet_name") == sheet_name))


def to_stg_shop_day(raw: DataFrame) -> DataFrame:
    """Header variants per row, dates, repaired numbers, typed columns; no shuffle."""
    typed: dict[str, Column] = {"sales_date": clean_excel_date(F.col("sales_date"))}
    for name in SHOP_DAILY_LOAD.field_names[1:]:
        number = repair_number(F.col(name))
        if name in SHOP_DAY_COUNTS:
            typed[name] = floor_int(number)
        elif name == "conversion_rate":
            typed[name] = rate(number)
        else:
            typed[name] = money(number)
    return contract_texts(raw, SHOP_DAILY_LOAD).select(
        "import_file_id",
        "shop_id",
        F.col("row_number").alias("source_row_number"),
        *[c.alias(n) for n, c in typed.items()],
    )


def to_stg_sku_day(raw: DataFrame) -> DataFrame:
    typed: dict[str, Column] = {"sales_date": clean_excel_date(F.col("sales_date"))}
    for name in SKU_DAILY_LOAD.field_names[1:]:
        typed[name] = money(repair_number(F.col(name))) if name in SKU_MONEY else F.col(name)
    return contract_texts(raw, SKU_DAILY_LOAD).select(
        "import_file_id",
        "shop_id",
        F.col("row_number").alias("source_row_number"),
        *[c.alias(n) for n, c in typed.items()],
    )


def narrow_fact(fact: DataFrame) -> DataFrame:
    """Canonical measures and lineage of a wide shop-day fact."""
    return fact.select("shop_id", "sales_date", *SHOP_DAY_FACT, "import_file_id", "source_row_number")


def payload_json(fact: DataFrame) -> Column:
    """Wide fact row -> raw payload JSON under the first accepted headers, without NULLs."""
    values = [
        (F.date_format("sales_date", "yyyy-MM-dd") if name == "sales_date" else F.col(name)).alias(
            SHOP_DAILY_LOAD.headers_of(name)[0]
        )
        for name in SHOP_DAILY_LOAD.field_names
    ]
    return F.to_json(F.struct(*values))


def backfill_layers(fact: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw rows, staging rows and narrow fact rebuilt from a wide fact.

    Every fact row gets its raw row through its import; staging is the wide row
    joined to that raw row on import and row number.
    """
    sheets = files.select("import_file_id", "sheet_name")
    named = lookup_join(fact.withColumn("raw_payload", payload_json(fact)), sheets, ["import_file_id"], "inner")
    raw = named.select("import_file_id", F.col("source_row_number").alias("row_number"), "sheet_name", "raw_payload")
    rows = raw.select("import_file_id", F.col("row_number").alias("source_row_number"))
    staging = fact.join(rows, ["import_file_id", "source_row_number"]).select(
        "import_file_id", "shop_id", "source_row_number", *SHOP_DAILY_LOAD.field_names
    )
    return raw, staging, narrow_fact(fact)
