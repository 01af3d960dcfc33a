"""Registered queries: each runs one operator or report over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..contracts import CANONICAL_COLUMNS, SHOP_DAILY_LOAD, SHOP_DAILY_SOURCE, SKU_DAILY_LOAD, SKU_SOURCE, SPU_SOURCE
from ..functions import (
    blank_to_null,
    excel_date,
    json_object_text,
    json_text_map,
    lenient_decimal,
    payload_text,
)
from ..operators import inventory as inv
from ..operators import merge, quality, rules
from ..operators.headers import extra_payload, extract_raw_rows, preview, resolve_headers, with_header_positions
from ..operators.joins import current_version, lookup_by_code, lookup_join, platform_id_of, resolve_shop, with_display_name
from ..operators.ranking import Order, Rank, dense_ranks
from ..plans import facts, reporting, reviews
from ..plans.normalise import concat_datasets, family_headers, normalize_dataset, normalize_family, sheet_payloads, sorted_dataset
from ..plans.staging import backfill_layers, scope_import, to_stg_shop_day, to_stg_sku_day
from ..session import configure, materialise, shared_dir
from ..sources import landed, sinks
from ..sources.cells import dense_cells, rows_from_cells
from ..sources.landed import parse_raw_payload, seed_rows, workbook_identity
from . import bindings as b
from .bindings import Tables

Query = Callable[[Tables], DataFrame]
REGISTRY: dict[str, Query] = {}
REFRESHED_AT = dt.datetime(2026, 1, 1)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def present(df: DataFrame) -> DataFrame:
    """Output types that compare alike everywhere: bigint, double, text for dates."""
    shown = []
    for field in df.schema.fields:
        kind, c = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        shown.append(c.alias(field.name))
    return df.select(*shown)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: present(function(Tables(configure(spark), sf_dir)))

    return {name: bound(function) for name, function in REGISTRY.items()}


# --- shop-day reports -------------------------------------------------------


def _shop_layers(t: Tables, since: dt.date | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    # Shop-days are few; the staging layer is written once and read by fact and view.
    staging = materialise(b.shop_day_staging(t, since))
    return facts.shop_day_facts(staging), b.dim_shop(t), staging


@query("view_shop_daily")
def view_shop_daily(t: Tables) -> DataFrame:
    return reporting.shop_daily(*_shop_layers(t))


@query("view_shop_monthly")
def view_shop_monthly(t: Tables) -> DataFrame:
    return reporting.shop_monthly(*_shop_layers(t))


@query("view_top_summary_daily")
def view_top_summary_daily(t: Tables) -> DataFrame:
    return reporting.top_summary_daily(reporting.shop_daily(*_shop_layers(t)))


@query("view_shop_rank_30d")
def view_shop_rank_30d(t: Tables) -> DataFrame:
    latest, since = b.recent(t)
    return reporting.shop_rank_30d(reporting.shop_daily(*_shop_layers(t, since)), latest)


@query("review_daily")
def review_daily(t: Tables) -> DataFrame:
    return reviews.review_daily(*_shop_layers(t))


@query("review_monthly")
def review_monthly(t: Tables) -> DataFrame:
    return reviews.review_monthly(*_shop_layers(t))


@query("current_version_join")
def current_version_join(t: Tables) -> DataFrame:
    fact, _, staging = _shop_layers(t)
    return current_version(fact, staging, ["shop_visitor_count", "conversion_rate"]).select(
        "shop_id",
        "sales_date",
        "import_file_id",
        "source_row_number",
        "gross_sales_amount",
        "shop_visitor_count",
        "conversion_rate",
    )


# --- SKU-day reports --------------------------------------------------------


def _sku_layers(t: Tables, since: dt.date | None = None) -> tuple[DataFrame, DataFrame]:
    return facts.sku_day_facts(b.sku_staging(t, since)), b.dim_shop(t)


@query("fact_sku_day")
def fact_sku_day(t: Tables) -> DataFrame:
    return facts.fact_sku_day(b.sku_staging(t))


@query("sku_display_name")
def sku_display_name(t: Tables) -> DataFrame:
    return facts.sku_display_name(b.sku_staging(t))


@query("display_name_join")
def display_name_join(t: Tables) -> DataFrame:
    staging = materialise(b.sku_staging(t))
    return with_display_name(facts.fact_sku_day(staging), facts.sku_display_name(staging)).select(
        "import_file_id", "shop_id", "sales_date", *facts.IDENTITY, "product_name", "source_row_count"
    )


@query("view_sku_daily")
def view_sku_daily(t: Tables) -> DataFrame:
    return reporting.sku_daily(*_sku_layers(t))


@query("view_sku_rank_30d")
def view_sku_rank_30d(t: Tables) -> DataFrame:
    latest, since = b.recent(t)
    return reporting.sku_rank_30d(reporting.sku_daily(*_sku_layers(t, since)), latest)


@query("view_product_cards_30d")
def view_product_cards_30d(t: Tables) -> DataFrame:
    latest, since = b.recent(t)
    return reporting.product_cards_30d(reporting.sku_daily(*_sku_layers(t, since)), latest)


# --- product monitoring -----------------------------------------------------


def _without_refresh_time(df: DataFrame) -> DataFrame:
    return df.drop("refreshed_at", "刷新时间")


@query("spu_snapshot")
def spu_snapshot(t: Tables) -> DataFrame:
    return _without_refresh_time(reviews.spu_snapshot(b.spu_source(t), REFRESHED_AT))


@query("view_spu_monitoring")
def view_spu_monitoring(t: Tables) -> DataFrame:
    return _without_refresh_time(reporting.spu_monitoring(reviews.spu_snapshot(b.spu_source(t), REFRESHED_AT)))


@query("view_spu_trial_cards")
def view_spu_trial_cards(t: Tables) -> DataFrame:
    view = reporting.spu_monitoring(reviews.spu_snapshot(b.spu_source(t), REFRESHED_AT))
    return _without_refresh_time(reporting.spu_trial_cards(view))


@query("review_spu")
def review_spu(t: Tables) -> DataFrame:
    return reviews.review_spu(b.spu_source(t))


# --- staging, facts, merges -------------------------------------------------


@query("typed_shop_day")
def typed_shop_day(t: Tables) -> DataFrame:
    return to_stg_shop_day(b.shop_day_raw(t))


@query("typed_sku_day")
def typed_sku_day(t: Tables) -> DataFrame:
    return to_stg_sku_day(b.sku_raw(t))


@query("upsert_shop_day")
def upsert_shop_day(t: Tables) -> DataFrame:
    return b.shop_day_fact(materialise(b.shop_day_staging(t)))


@query("upsert_sku_day")
def upsert_sku_day(t: Tables) -> DataFrame:
    return b.sku_fact(materialise(b.sku_staging(t)))


@query("upsert_dimension")
def upsert_dimension(t: Tables) -> DataFrame:
    target = t.supplier.select(
        F.lit(1).alias("platform_id"),
        F.concat(F.lit("shop_"), "s_suppkey").alias("shop_code"),
        F.col("s_name").alias("shop_name"),
        (F.col("s_suppkey") % 3 != 0).alias("is_active"),
        F.col("s_suppkey").alias("created_at"),
    )
    batch = t.customer.select(
        F.lit(1).alias("platform_id"),
        F.concat(F.lit("shop_"), F.col("c_custkey") * 2).alias("shop_code"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("shop_name"),
        F.lit(True).alias("is_active"),
        F.lit(-1).cast("bigint").alias("created_at"),
    )
    return merge.upsert(target, batch, ["platform_id", "shop_code"], ["shop_name", "is_active"], ["created_at"])


@query("seed_source_types")
def seed_source_types(t: Tables) -> DataFrame:
    platforms = t.customer.select(F.col("c_custkey").alias("platform_id"), "c_name")
    first = SHOP_DAILY_LOAD.code
    existing = platforms.filter(F.col("c_name").endswith("0")).select(
        "platform_id",
        F.lit(first).alias("file_type_code"),
        F.col("c_name").alias("file_type_name"),
        F.lit("shop_day").alias("grain_code"),
        F.lit(1).alias("version"),
        F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("is_active"),
    )
    return merge.insert_missing(existing, seed_rows(platforms), ["platform_id", "file_type_code", "version"])


@query("register_import")
def register_import(t: Tables) -> DataFrame:
    files = t.orders.select((F.col("o_orderkey") + 1).alias("import_file_id"))
    shops = b.dim_shop(t).select(F.col("shop_id").alias("c_nationkey"), "platform_id", "shop_code")
    new = lookup_join(t.customer, shops, ["c_nationkey"], "inner").select(
        "platform_id",
        "shop_code",
        F.concat(F.lit("/landing/"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("file_path"),
    )
    return merge.register_imports(files, new, ["file_path"])


@query("update_from_join")
def update_from_join(t: Tables) -> DataFrame:
    target = t.orders.select(
        F.col("o_orderkey").alias("import_file_id"),
        F.col("o_custkey").alias("platform_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("shop_daily")).otherwise(F.lit("other")).alias("report_type"),
        F.lit(None).cast("bigint").alias("source_file_type_id"),
    )
    source = t.customer.select(
        F.col("c_custkey").alias("platform_id"),
        F.lit("shop_daily").alias("report_type"),
        (F.col("c_custkey") * 10 + 1).alias("source_file_type_id"),
    )
    return merge.update_from(target, source, ["platform_id", "report_type"], ["source_file_type_id"])


@query("backfill_layers")
def backfill(t: Tables) -> DataFrame:
    wide = b.shop_day_clean(t).withColumns(
        {
            "import_file_id": F.col("shop_id") + 1,
            "source_row_number": F.date_diff("sales_date", F.lit(b.DAY_ZERO)) + 1,
        }
    )
    files = b.dim_shop(t).select(
        (F.col("shop_id") + 1).alias("import_file_id"), F.concat("shop_code", F.lit("日报数据源")).alias("sheet_name")
    )
    raw, staging, narrow = backfill_layers(materialise(wide), files)
    keys = ["import_file_id", "source_row_number"]
    return (
        raw.withColumnRenamed("row_number", "source_row_number")
        .join(staging.select(*keys, "sales_date", "uv_value"), keys)
        .join(narrow.select(*keys, "refund_amount"), keys)
    )



# --- landed rows, headers, payloads -----------------------------------------


@query("raw_rows_scan")
def raw_rows_scan(t: Tables) -> DataFrame:
    landed = t.events.select(
        F.col("user_id").cast("int").alias("import_file_id"),
        F.col("event_id").cast("int").alias("row_number"),
        F.when(F.col("user_id") % 7 != 0, F.col("event_type")).otherwise(F.lit("")).alias("sheet_name"),
        F.col("props").alias("raw_payload"),
    )
    rows = parse_raw_payload(landed)
    return rows.select(
        "import_file_id",
        "row_number",
        "sheet_name",
        F.size("raw_payload").alias("field_count"),
        payload_text(F.col("raw_payload"), "k").alias("k_text"),
    )


@query("cell_rows_assemble")
def cell_rows_assemble(t: Tables) -> DataFrame:
    rows = rows_from_cells(b.order_cells(t), b.customer_strings(t))
    dense = dense_cells(F.col("cells"))
    return rows.select(
        "workbook_identifier",
        "sheet_name",
        "sheet_index",
        "row_number",
        F.size(dense).alias("width"),
        F.array_join(dense, "|").alias("row_text"),
    )


@query("workbook_identity")
def workbook_identity_parse(t: Tables) -> DataFrame:
    paths = t.orders.select(
        "o_orderkey",
        F.concat(
            F.lit("/landing/"),
            "o_orderpriority",
            F.lit("/pdd_"),
            "o_custkey",
            F.lit("_workbook_"),
            F.year("o_orderdate"),
            F.lit(".xlsx"),
        ).alias("path"),
    )
    return workbook_identity(paths, "path").drop("path")



@query("header_resolution")
def header_resolution(t: Tables) -> DataFrame:
    resolved = resolve_headers(with_header_positions(b.shop_daily_headers(t)), SHOP_DAILY_LOAD, strict=True)
    date_at = F.filter("positions", lambda h: h["name"] == "日期")
    return resolved.select(
        "workbook_identifier",
        "source_header_variant",
        F.size("headers").alias("header_count"),
        date_at[0]["idx"].alias("date_column"),
        F.array_join("unexpected_headers", ",").alias("unexpected_headers"),
    )


@query("header_schema_diff")
def header_schema_diff(t: Tables) -> DataFrame:
    resolved = resolve_headers(with_header_positions(b.spu_headers(t)), SPU_SOURCE, strict=False)
    return resolved.select(
        "workbook_identifier",
        F.size("mapping").alias("matched_count"),
        F.array_join("headers", ",").alias("headers"),
        F.array_join("missing_headers", ",").alias("missing_headers"),
        F.array_join("unexpected_headers", ",").alias("unexpected_headers"),
    )


@query("variant_coalesce")
def variant_coalesce(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    deal = F.when(key % 4 == 1, F.lit(" 　")).when(key % 4 != 0, F.concat(F.lit("　"), "o_totalprice"))
    paid = F.when(key % 6 != 0, F.concat(F.lit("p"), key, F.lit("\t")))
    payload = F.create_map(F.lit("成交金额"), deal, F.lit("支付金额"), paid)
    return t.orders.select("o_orderkey", payload_text(payload, "成交金额", "支付金额").alias("amount_text"))


@query("raw_extract")
def raw_extract(t: Tables) -> DataFrame:
    """Header 状态 occurs twice, so its last column counts; column 2 has no name."""
    key = F.col("o_orderkey")
    names = F.array(F.lit("状态"), F.lit(" 金额 "), F.lit(""), F.lit("状态"))
    status = F.when(key % 9 == 0, F.lit(" ")).otherwise(F.concat(F.lit("　"), "o_orderstatus"))
    amount = F.when(key % 9 == 0, F.lit("\t")).otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
    cells = F.array(F.lit("first"), amount, F.lit("unnamed"), status)
    # Some rows end before the last column.
    ragged = F.when(key % 5 == 0, F.slice(cells, 1, 3)).otherwise(cells)
    headed = with_header_positions(t.spread("orders").withColumn("header_cells", b.indexed_map(names)), "header_cells")
    rows = headed.select(key.alias("row_number"), "positions", b.indexed_map(ragged).alias("cells"))
    return extract_raw_rows(rows).select("row_number", json_object_text(F.col("raw_payload")).alias("payload"))


@query("blank_to_null")
def blank_text(t: Tables) -> DataFrame:
    padded = F.when(F.col("doc_id") % 5 == 0, F.lit("　\t\xa0 ")).otherwise(
        F.concat(F.lit(" 　\x1f"), "text", F.lit(" \xa0\n"))
    )
    cleaned = blank_to_null(padded)
    return t.documents.select("doc_id", F.length(cleaned).alias("n_chars"), F.md5(cleaned).alias("digest"))



@query("extra_payload")
def extra_payload_json(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    payload = F.create_map(
        F.lit("日期"), F.lit("1"),
        F.lit("备注"), F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit('a"b\\'), "o_orderstatus")),
        F.lit("SPU"), F.lit("x"),
        F.lit("A列"), F.when(key % 2 == 0, F.lit("")).otherwise(F.col("o_orderpriority")),
    )
    mapping = F.create_map(F.lit("sales_date"), F.lit("日期"), F.lit("spu_name"), F.lit("SPU"))
    return t.orders.select("o_orderkey", extra_payload(payload, mapping).alias("extra"))



@query("json_extract")
def json_extract(t: Tables) -> DataFrame:
    wide = F.to_json(F.struct(F.col("o_orderstatus").alias("商家实收金额（元）"), F.col("o_orderkey").alias("SKU-ID")))
    narrow = F.to_json(F.struct(F.col("o_orderpriority").alias("商家实收金额(元)")))
    document = F.when(F.col("o_orderkey") % 2 == 0, wide).otherwise(narrow)
    payload = json_text_map(document)
    return t.orders.select(
        "o_orderkey",
        payload_text(payload, *SKU_DAILY_LOAD.headers_of("merchant_net_amount")).alias("net_text"),
        payload_text(payload, "SKU-ID").alias("sku_text"),
    )


@query("normalize_dataset")
def normalize(t: Tables) -> DataFrame:
    rows = b.sku_sheet_rows(t)
    files = b.shop_files(t)
    return normalize_dataset(rows, files, SKU_SOURCE, inv.batch_id(files)).select(
        "batch_id",
        "dataset_version",
        "dataset_code",
        "grain_code",
        "workbook_identifier",
        "workbook_file_name",
        "shop_code",
        "sheet_name",
        "sheet_index",
        "source_row_number",
        "source_header_variant",
        "source_extra_payload_json",
        *SKU_SOURCE.field_names,
    )



@query("preview_rows")
def preview_rows(t: Tables) -> DataFrame:
    payloads = sheet_payloads(b.sku_sheet_rows(t), SKU_DAILY_LOAD, strict=True)
    return preview(payloads, SKU_DAILY_LOAD, ["workbook_identifier"])


# --- inventory --------------------------------------------------------------


@query("sheet_detect")
def sheet_detect(t: Tables) -> DataFrame:
    return inv.detect_sheet(b.order_sheets(t), SHOP_DAILY_LOAD.sheet_token, ["workbook_identifier"])


@query("sheet_override")
def sheet_override(t: Tables) -> DataFrame:
    """A sheet named explicitly replaces detection."""
    return inv.choose_sheet(b.order_sheets(t), SHOP_DAILY_LOAD.sheet_token, ["workbook_identifier"], " SKU源数据 ")


@query("sheet_classify")
def sheet_classify(t: Tables) -> DataFrame:
    return b.order_sheets(t).withColumn("sheet_group", inv.classify_sheet(F.col("sheet_name")))


@query("classification_doc")
def classification_doc(t: Tables) -> DataFrame:
    sheets = b.order_sheets(t).withColumn("sheet_group", inv.classify_sheet(F.col("sheet_name")))
    return inv.classification_doc(sheets).select("workbook_identifier", F.to_json("sheets").alias("document"))


@query("sheet_inventory")
def sheet_inventory(t: Tables) -> DataFrame:
    counts = inv.sheet_row_counts(b.line_sheet_rows(t), ["workbook_identifier"])
    listed = inv.sheet_inventory(counts, SHOP_DAILY_LOAD, F.lit("①" + SHOP_DAILY_LOAD.sheet_token))
    return listed.withColumn("sheet_group", inv.classify_sheet(F.col("sheet_name")))


@query("sheet_registry_inventory")
def sheet_registry_inventory(t: Tables) -> DataFrame:
    """All listed sheets with their rows, also those that have none."""
    by = ["workbook_identifier"]
    counts = inv.sheet_row_counts(b.order_sheet_rows(t), by, b.order_sheets(t))
    target = inv.detect_sheet(counts, SHOP_DAILY_LOAD.sheet_token, by).withColumnRenamed("sheet_name", "target")
    return inv.sheet_inventory(lookup_join(counts, target, by, "left"), SHOP_DAILY_LOAD, F.col("target")).drop("target")


@query("family_inventory")
def family_inventory(t: Tables) -> DataFrame:
    files = b.order_files(t)
    counts = inv.sheet_row_counts(b.order_sheet_rows(t), ["workbook_identifier"], b.order_sheets(t))
    counted = counts.join(files.drop("workbook_file_hash"), "workbook_identifier")
    return inv.family_inventory(counted, inv.batch_id(files))


@query("sheet_shape")
def sheet_shape(t: Tables) -> DataFrame:
    return inv.sheet_shape_violations(b.order_sheet_rows(t), [SHOP_DAILY_SOURCE, SKU_SOURCE, SPU_SOURCE], b.order_sheets(t), b.order_files(t))


@query("normalize_family")
def normalize_whole_family(t: Tables) -> DataFrame:
    """All seven datasets from one pass; the digest covers every canonical column."""
    files = b.shop_files(t)
    rows = normalize_family(b.family_rows(t), files, inv.batch_id(files))
    values = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in CANONICAL_COLUMNS])
    lineage = ["dataset_code", "grain_code", "workbook_identifier", "shop_code", "sheet_name", "sheet_index", "source_row_number"]
    return rows.select(*lineage, "source_header_variant", "source_extra_payload_json", F.md5(values.cast("binary")).alias("digest"))


def _family_counts(t: Tables) -> DataFrame:
    rows = normalize_family(b.family_rows(t), b.shop_files(t), "b")
    return materialise(inv.dataset_row_counts(rows, ["dataset_code", "workbook_identifier"]))


@query("schema_manifest")
def schema_manifest(t: Tables) -> DataFrame:
    manifest = inv.schema_manifest(family_headers(b.family_rows(t)), "b", _family_counts(t))
    joined = [F.array_join(c, ",").alias(c) for c in ("headers", "missing_headers", "unexpected_headers")]
    return manifest.select("dataset_code", "grain_code", "workbook_identifier", "sheet_name", "row_count", F.size("mapping").alias("matched_count"), *joined)


@query("run_manifest")
def run_manifest(t: Tables) -> DataFrame:
    return inv.run_manifest(b.shop_files(t), _family_counts(t), "b")


@query("dataset_row_counts")
def dataset_row_counts(t: Tables) -> DataFrame:
    return inv.dataset_row_counts(b.line_sheet_rows(t), ["workbook_identifier", "dataset_code"])


@query("batch_fingerprint")
def batch_fingerprint(t: Tables) -> DataFrame:
    files = b.order_book(t).select(
        "o_custkey", "workbook_identifier", F.sha2(F.col("o_totalprice").cast("decimal(14,2)").cast("string"), 256).alias("workbook_file_hash")
    )
    return inv.batch_ids(files, ["o_custkey"])


# --- scalars ----------------------------------------------------------------


@query("excel_date")
def excel_date_parse(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    serial = F.date_diff(day, F.lit(dt.date(1899, 12, 30))).cast("string")
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, F.concat(serial, F.lit(".75")))
        .when(kind == 1, F.concat(F.lit("　"), serial, F.lit(" ")))
        .when(kind == 2, F.date_format(day, "yyyy/M/d"))
        .when(kind == 3, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 4, F.lit(" "))
        .otherwise(day.cast("string"))
    )
    return t.orders.select("o_orderkey", excel_date(text).alias("sales_date"))



@query("lenient_decimal")
def lenient_number(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    kind = F.col("l_linenumber")
    text = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.replace(price, F.lit("."), F.lit("..")))
        .when(kind == 4, F.lit("n/a"))
        .otherwise(price)
    )
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum(lenient_decimal(text)).alias("total"), F.count(F.lit(1)).alias("line_count")
    )



# --- quality ----------------------------------------------------------------


@query("required_columns_missing")
def required_columns_missing(t: Tables) -> DataFrame:
    required = SHOP_DAILY_LOAD.field_names
    key = F.col("o_orderkey")
    kept = F.filter(
        F.array(*[F.lit(n) for n in required]), lambda n: (F.length(n) + key) % 7 != 0
    )
    present_columns = b.order_book(t).select("workbook_identifier", F.explode(kept).alias("column_name"))
    return quality.missing_columns(required, present_columns, ["workbook_identifier"])


@query("dq_duplicate_keys")
def dq_duplicate_keys(t: Tables) -> DataFrame:
    status = F.coalesce(F.when(F.col("l_linestatus") == "O", F.lit("O")), F.lit("")).alias("status_key")
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber", status])


@query("dq_orphans")
def dq_orphans(t: Tables) -> DataFrame:
    child = t.orders.select(F.col("o_orderkey").alias("order_id"))
    parent = t.lineitem.select(F.col("l_orderkey").alias("order_id"))
    return quality.orphans(child, parent, ["order_id"])


@query("dq_nulls")
def dq_nulls(t: Tables) -> DataFrame:
    return quality.null_violations(
        b.sku_staging(t),
        ["shop_id", "sales_date", "product_name", "merchant_sku_code", "product_specification", "sku_id"],
    )


@query("dq_rules")
def dq_rules(t: Tables) -> DataFrame:
    """All declared rules over all layers, one row for each."""
    return rules.check(b.rule_tables(t))


@query("dq_lineage_delta")
def dq_lineage_delta(t: Tables) -> DataFrame:
    """Lineage of the rows of one import, from layers that are kept by import; the cut is the feature."""
    staging, raw = _new_path(t, "staging"), _new_path(t, "raw")
    rows = t.lineitem.withColumn("import_file_id", F.pmod("l_suppkey", F.lit(7)).cast("int"))
    number = F.when(F.col("l_linenumber") != 4, F.col("l_orderkey") + F.when(F.col("l_partkey") % 20 == 0, 1).otherwise(0))
    shop = F.when(F.col("l_linenumber") != 5, F.col("l_suppkey") % 27)
    sinks.append_import(rows.select("import_file_id", number.alias("row_number"), shop.alias("shop_id")), staging)
    sinks.append_import(rows.select("import_file_id", F.col("l_orderkey").alias("row_number")), raw)
    parents = {"raw": (t.spark.read.parquet(raw), ["import_file_id", "row_number"]), "shops": (b.dim_shop(t), ["shop_id"])}
    return quality.lineage_delta(t.spark.read.parquet(staging), parents, 3)


@query("metric_outliers")
def metric_outliers(t: Tables) -> DataFrame:
    return quality.metric_outliers(b.shop_day_clean(t))


@query("dq_lineage")
def dq_lineage(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("r_name"))
    return quality.lineage_violations(
        rows, {"labels": (t.labels, ["doc_id"]), "region": (t.region, ["r_name"])}
    )


@query("metric_reconcile")
def metric_reconcile(t: Tables) -> DataFrame:
    return quality.reconcile_metrics(b.shop_day_clean(t), ["shop_id"])


@query("missing_identifiers")
def missing_identifiers(t: Tables) -> DataFrame:
    return quality.missing_identifiers(
        b.sku_staging(t), ["product_id", "sku_id", "merchant_sku_code", "product_specification"], ["shop_id"]
    )


@query("identifier_conflicts")
def identifier_conflicts(t: Tables) -> DataFrame:
    pairs = [
        ("sku_id", "product_id"),
        ("sku_id", "merchant_sku_code"),
        ("merchant_sku_code", "sku_id"),
        ("product_id", "product_specification"),
        ("product_id", "sku_id"),
    ]
    return quality.identifier_conflicts(b.sku_staging(t), pairs)


@query("duplicate_source_rows")
def duplicate_source_rows(t: Tables) -> DataFrame:
    return quality.duplicate_keys(
        b.sku_lines(t),
        ["shop_id", "sales_date", "product_id", "sku_id", "merchant_sku_code", "product_specification"],
        "source_rows",
    )


@query("coverage_by_shop")
def coverage_by_shop(t: Tables) -> DataFrame:
    return quality.coverage(b.shop_day_staging(t), ["shop_id"])


@query("layer_reconcile")
def layer_reconcile(t: Tables) -> DataFrame:
    staging = materialise(b.sku_staging(t))
    return quality.reconcile_layers(
        {"raw": b.sku_raw(t), "staging": staging, "fact": facts.sku_day_facts(staging)}, "shop_id"
    )


# --- written and read back --------------------------------------------------


def _new_path(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Texts with commas, quotes, line breaks and outer blanks through the CSV writer and the strict reader."""
    path = _new_path(t, "csv")
    texts = t.documents.select("doc_id", "text", F.concat(F.lit(' "'), "lang", F.lit('",\n ')).alias("note"))
    sinks.write_csv(texts, path, ["note", "doc_id", "text"], ["doc_id"])
    back = landed.read_csv_strict(t.spark, path, "note string, doc_id bigint, text string")
    return back.select("doc_id", "note", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("raw_rows_json_roundtrip")
def raw_rows_json_roundtrip(t: Tables) -> DataFrame:
    path = _new_path(t, "json")
    exported = t.events.select(
        F.col("user_id").cast("int").alias("import_file_id"),
        F.col("event_id").cast("int").alias("row_number"),
        F.col("event_type").alias("sheet_name"),
        F.col("props").alias("raw_payload"),
    )
    sinks.write_manifest(exported, path)
    return landed.read_raw_rows_json(t.spark, path).select(
        "import_file_id", "row_number", "sheet_name", payload_text(F.col("raw_payload"), "k").alias("k_text")
    )


@query("dataset_roundtrip")
def dataset_roundtrip(t: Tables) -> DataFrame:
    root = _new_path(t, "family")
    sinks.write_dataset(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), f"{root}/datasets/{SPU_SOURCE.code}")
    return landed.read_dataset(t.spark, root, SPU_SOURCE.code)


@query("file_fingerprint")
def file_fingerprint(t: Tables) -> DataFrame:
    """One text file per supplier row, hashed as landed workbooks are."""
    root = _new_path(t, "files")
    copy = F.row_number().over(W.partitionBy("s_suppkey").orderBy("s_name"))
    book = F.concat_ws("-", F.coalesce(F.col("s_suppkey").cast("string"), F.lit("")), copy).alias("book")
    named = t.supplier.filter("s_name is not null").select(book, "s_name")
    dealt = named.repartition(4 * t.spark.sparkContext.defaultParallelism, "book")
    # Files are moved to their place by the tasks, not one by one by the driver; nobody reads them before the job is done.
    dealt.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("book").text(root)
    found = landed.file_fingerprints(t.spark, root)
    number = F.regexp_extract("workbook_path", "book=([0-9]+)-", 1).try_cast("bigint")
    # A supplier without a name has no file.
    bare = t.supplier.filter("s_name is null").select("s_suppkey", F.lit(None).cast("string").alias("workbook_file_hash"))
    return found.select(number.alias("s_suppkey"), "workbook_file_hash").unionByName(bare)


@query("published_snapshot")
def published_snapshot(t: Tables) -> DataFrame:
    """The second of two rebuilds is the one that readers see."""
    root = _new_path(t, "published")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.publish(orders.filter("o_orderstatus = 'F'"), root)
    sinks.refresh_snapshot(orders.filter("o_orderstatus <> 'F'"), root)
    return sinks.read_published(t.spark, root)


@query("appended_imports")
def appended_imports(t: Tables) -> DataFrame:
    """Imports appended in two runs; one sheet of one import is read back."""
    path = _new_path(t, "layer")
    rows = t.orders.select(
        F.col("o_orderkey").alias("row_number"),
        F.col("o_orderpriority").alias("sheet_name"),
        (F.col("o_custkey") % 3).cast("int").alias("import_file_id"),
    )
    sinks.append_import(rows.filter("import_file_id = 0"), path)
    sinks.append_import(rows.filter("import_file_id > 0"), path)
    return scope_import(t.spark.read.parquet(path), 1, "1-URGENT")


# --- order of written output ------------------------------------------------


def _placed(t: Tables, df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """The sort keys with the positions at which the rows lie in the written files; rows out of order fail the job."""
    path = _new_path(t, "ordered")
    sinks.write_dataset(df, path)
    rows = landed.read_ordered(t.spark, path)
    inv.require_none(landed.out_of_order(rows, order), "order of the written rows")
    return rows.select(*[c for c, _ in order], "position")


@query("ordered_review_daily")
def ordered_review_daily(t: Tables) -> DataFrame:
    return _placed(t, reviews.review_daily(*_shop_layers(t)), [("店铺", False), ("日期", False)])


@query("ordered_review_monthly")
def ordered_review_monthly(t: Tables) -> DataFrame:
    return _placed(t, reviews.review_monthly(*_shop_layers(t)), [("店铺", False), ("月份", False)])


@query("ordered_review_spu")
def ordered_review_spu(t: Tables) -> DataFrame:
    rows = reviews.review_spu(b.spu_source(t)).withColumn("销售额", F.col("销售额").cast("decimal(20,2)"))
    return _placed(t, rows, [("店铺", True), ("日期", True), ("销售额", True), ("SPU", False), ("计划名", False), ("链接名称", False)])


@query("ordered_snapshot")
def ordered_snapshot(t: Tables) -> DataFrame:
    return _placed(t, reviews.spu_snapshot(b.spu_source(t), REFRESHED_AT), [(k, False) for k in reviews.SPU_KEYS])


@query("ordered_family")
def ordered_family(t: Tables) -> DataFrame:
    """The seven datasets written side by side in one pass; positions inside each dataset."""
    root = _new_path(t, "family")
    rows = normalize_family(b.family_rows(t), b.shop_files(t), "b")
    # Sorting samples its input, so the rows are derived once and read twice.
    sinks.write_datasets(sorted_dataset(materialise(rows)), root)
    placed = landed.read_ordered(t.spark, f"{root}/datasets", ("dataset_code",))
    keys = ["workbook_identifier", "sheet_index", "source_row_number"]
    inv.require_none(landed.out_of_order(placed, [(k, False) for k in keys], ("dataset_code",)), "order of the written rows")
    return placed.select("dataset_code", *keys, "position")


# --- paths that only large inputs take by themselves ------------------------


@query("salted_lookup_join")
def salted_lookup_join(t: Tables) -> DataFrame:
    """Three keys hold all line items, so each is split; nothing is broadcast."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    flags = rows.groupBy("l_returnflag").agg(F.count("*").alias("flag_rows"), F.max("l_orderkey").alias("last_order"))
    return lookup_join(rows, flags, ["l_returnflag"], "left", max_rows=0, partitions=64)


@query("distributed_rank")
def distributed_rank(t: Tables) -> DataFrame:
    """Global and grouped dense ranks through range-partitioned keys, with NULL keys and ties."""
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_quantity") > 1, F.col("l_quantity").cast("bigint")).alias("units"),
    )
    ranks = [
        Rank("rank_all", (Order("units", True), Order("l_orderkey"))),
        Rank("rank_in_flag", (Order("units"),), ("l_returnflag",)),
    ]
    return dense_ranks(rows, ranks, single_task_rows=0, broadcast_rows=0)


# --- register and dimension look-ups ----------------------------------------


@query("latest_imports")
def latest_imports(t: Tables) -> DataFrame:
    """The five imports listed last; the limit is the feature."""
    files = t.orders.select(F.col("o_orderkey").alias("import_file_id"), F.col("o_orderdate").alias("imported_at"))
    return merge.latest_imports(files, 5).select("import_file_id")


@query("union_ids")
def union_ids(t: Tables) -> DataFrame:
    return merge.union_ids(t.orders.select(F.col("o_custkey").alias("id")), t.customer.select("c_custkey"))


@query("concat_datasets")
def concat(t: Tables) -> DataFrame:
    """Datasets with different columns: absent ones are NULL."""
    return concat_datasets(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
            t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
            t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand")),
        ]
    )


@query("resolve_shop")
def resolve(t: Tables) -> DataFrame:
    """Customers act as shops of the platforms that orders name by status."""
    platforms = t.orders.select(F.col("o_custkey").alias("platform_id"), F.col("o_orderpriority").alias("platform_code"))
    shops = t.customer.select(
        F.col("c_custkey").alias("platform_id"), F.col("c_custkey").alias("shop_id"), F.col("c_mktsegment").alias("shop_code")
    )
    return resolve_shop(platforms, shops, "1-URGENT", "BUILDING")


@query("platform_lookup")
def platform_lookup(t: Tables) -> DataFrame:
    """Customers of one platform, whose id is looked up by its code first."""
    platforms = t.region.select(F.col("r_regionkey").alias("platform_id"), F.col("r_name").alias("platform_code"))
    shops = t.nation.filter(F.col("n_regionkey") == platform_id_of(platforms, "ASIA")).select(F.col("n_nationkey").alias("c_nationkey"))
    return lookup_join(t.customer, shops, ["c_nationkey"], "inner").select("c_custkey")


@query("lookup_by_code")
def by_code(t: Tables) -> DataFrame:
    return lookup_by_code(t.part.select("p_partkey", "p_brand"), "p_brand", "Brand#11")
