import hashlib
import json

import pytest
from pyspark.sql import functions as F

from salesmart.contracts import DATASET_COLUMNS, DATASETS, SHOP_DAILY_LOAD, SHOP_DAILY_SOURCE, SKU_SOURCE
from salesmart.operators import inventory as inv
from salesmart.operators.headers import extract_raw_rows, preview, resolve_headers, with_header_positions
from salesmart.plans.normalise import concat_datasets, normalize_dataset, sheet_payloads, sorted_dataset
from salesmart.plans.staging import scope_import, to_stg_shop_day
from salesmart.sources import landed
from salesmart.sources.cells import column_index, dense_cells, rows_from_cells

CELLS = "workbook_identifier string, sheet_name string, sheet_index int, row_number int, cells map<int,string>"


def headers_of(spark, names):
    df = spark.createDataFrame([(dict(enumerate(names)),)], "cells map<int,string>")
    return with_header_positions(df)


def test_column_index(spark):
    refs = {"A1": 0, "Z3": 25, "AA10": 26, "az2": 51, "XFD1": 16383}
    df = spark.createDataFrame([(r,) for r in refs], "r string")
    assert {r["r"]: r["i"] for r in df.select("r", column_index(F.col("r")).alias("i")).collect()} == refs


def test_rows_from_cells(spark):
    cells = spark.createDataFrame(
        [
            ("w", "s", 1, 1, "A1", "s", "0"),
            ("w", "s", 1, 1, "C1", "inlineStr", "in"),
            ("w", "s", 1, 4, "B4", "n", "12"),
            ("w", "s", 1, 4, "AA4", "n", None),
        ],
        "workbook_identifier string, sheet_name string, sheet_index int, row_number int, cell_ref string, cell_type string, value string",
    )
    strings = spark.createDataFrame([("w", 0, "日期")], "workbook_identifier string, string_index int, text string")
    rows = rows_from_cells(cells, strings).select("row_number", dense_cells(F.col("cells")).alias("c"))
    got = {r["row_number"]: r["c"] for r in rows.collect()}
    assert got == {1: ["日期", "", "in"], 4: ["", "12", *[""] * 25]}
    with pytest.raises(Exception, match="no shared string: A1"):
        rows_from_cells(cells, strings.limit(0)).collect()


def test_header_positions_last_column_wins(spark):
    row = headers_of(spark, ["日期", "", " 金额 ", "日期"]).first()
    assert row["headers"] == ["日期", "金额"]
    assert [(h["name"], h["idx"]) for h in row["positions"]] == [("日期", 3), ("金额", 2)]


def test_strict_resolution_names_all_missing(spark):
    names = [f.headers[0] for f in SHOP_DAILY_LOAD.fields if f.name not in ("uv_value", "buyer_count")]
    with pytest.raises(Exception, match="no column for: 成交买家数 / 支付买家数, UV价值"):
        resolve_headers(headers_of(spark, names), SHOP_DAILY_LOAD).collect()


def test_variant_priority_differs_between_contracts(spark):
    names = [h for f in SHOP_DAILY_SOURCE.fields for h in f.headers] + ["备注"]
    strict = resolve_headers(headers_of(spark, names), SHOP_DAILY_LOAD).first()
    tolerant = resolve_headers(headers_of(spark, names), SHOP_DAILY_SOURCE, strict=False).first()
    assert strict["mapping"]["buyer_count"] == "成交买家数"
    assert tolerant["mapping"]["buyer_count"] == "支付买家数"
    assert tolerant["unexpected_headers"] == ["成交买家数", "成交订单数", "成交金额", "成交转化率", "店铺评分", "备注"]


def test_tolerant_resolution_reports_single_variant_fields_only(spark):
    names = [f.headers[0] for f in SHOP_DAILY_SOURCE.fields if f.name not in ("uv_value", "buyer_count")]
    row = resolve_headers(headers_of(spark, names), SHOP_DAILY_SOURCE, strict=False).first()
    assert row["missing_headers"] == ["UV价值"]
    assert "buyer_count" not in row["mapping"]
    expected = json.dumps(row["mapping"], ensure_ascii=False, sort_keys=True)
    assert row["source_header_variant"] == expected


@pytest.fixture(scope="module")
def sheet(spark):
    header = [h for f in SKU_SOURCE.fields for h in f.headers[-1:]] + ["备注", "颜色"]
    data = [
        ["45658.0", " 商品A ", "1", "", "红", "2", "9.90", "8.80", "S1", "", ""],
        ["", " ", "　", "", "", "", "", "", "", "", ""],
        ["2025/1/9", "商品B", "2", "C", "", "1", "776..03"],
        ["2025-01-10", "商品C", "3", "", "", "1", "5", "4", "S3", "y", "x"],
    ]
    rows = [("pdd_1_workbook_2026", "①SKU源数据", 3, n, dict(enumerate(r))) for n, r in zip([1, 2, 3, 5, 6], [header, *data], strict=True)]
    return spark.createDataFrame(rows, CELLS)


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame(
        [("pdd_1_workbook_2026", "/x/pdd_1_workbook_2026.xlsx", "pdd_1_workbook_2026.xlsx", "h", "pdd_1")],
        "workbook_identifier string, workbook_path string, workbook_file_name string, workbook_file_hash string, shop_code string",
    )


def test_normalize_dataset(spark, sheet, files):
    out = normalize_dataset(sheet, files, SKU_SOURCE, "b1")
    assert out.columns == DATASET_COLUMNS and len(DATASET_COLUMNS) == 68
    rows = [r.asDict() for r in sorted_dataset(concat_datasets([out])).collect()]
    assert [r["source_row_number"] for r in rows] == [2, 5, 6]
    first, second, third = rows
    assert (first["sales_date"], first["product_name"], first["merchant_sku_code"]) == ("2025-01-01", "商品A", None)
    assert (second["sales_date"], second["gross_product_amount"], second["sku_id"]) == ("2025/1/9", "776..03", None)
    assert first["source_extra_payload_json"] is None
    assert third["source_extra_payload_json"] == '{"备注": "y", "颜色": "x"}'
    assert (first["batch_id"], first["shop_code"], first["grain_code"], first["spu_name"]) == ("b1", "pdd_1", "sku_day", None)


def test_preview(spark, sheet):
    payloads = sheet_payloads(sheet, SKU_SOURCE, strict=True)
    rows = sorted(preview(payloads, SKU_SOURCE, ["workbook_identifier"], n=2).collect(), key=lambda r: r["source_row_number"])
    assert [(r["source_row_number"], r["sales_date"], r["merchant_sku_code"]) for r in rows] == [
        ("2", "2025-01-01", ""),
        ("5", "2025/1/9", "C"),
    ]


def test_header_must_be_on_row_one(spark, sheet):
    moved = sheet.withColumn("row_number", F.col("row_number") + 1)
    with pytest.raises(Exception, match="sheet without header row"):
        sheet_payloads(moved, SKU_SOURCE, strict=False).collect()


def test_shape_violations(spark, sheet):
    inv.require_none(inv.sheet_shape_violations(sheet, [SKU_SOURCE]), "layout")
    both = inv.sheet_shape_violations(sheet, [SKU_SOURCE, SHOP_DAILY_SOURCE])
    assert [(r["dataset_code"], r["reason"]) for r in both.collect()] == [
        ("shop_daily_source", "one sheet must be named for it, not 0")
    ]
    with pytest.raises(ValueError, match="layout"):
        inv.require_none(both, "layout")
    late = inv.sheet_shape_violations(sheet.filter("row_number > 1"), [SKU_SOURCE]).first()
    assert late["reason"] == "its first row is not the header row"


def test_extract_raw_rows_drops_blank(spark, sheet):
    headed = with_header_positions(spark.createDataFrame([({0: "a", 1: "a", 3: "b"},)], "h map<int,string>"), "h")
    data = spark.createDataFrame([(1, {0: "x", 2: "y"}), (2, {1: " v "})], "row_number int, cells map<int,string>")
    rows = extract_raw_rows(data.crossJoin(headed.select("positions"))).collect()
    assert [(r["row_number"], r["raw_payload"]) for r in rows] == [(2, {"a": "v", "b": ""})]


def test_staging_coalesces_variants_per_row(spark):
    base = {"日期": "45658", "店铺访客数": "12.0", "商品收藏用户数": "", "退款金额": " 3.005 "}
    raw = spark.createDataFrame(
        [
            (1, 7, 2, "s", {**base, "成交金额": " ", "支付金额": "776..03", "支付买家数": "5"}),
            (1, 7, 3, "s", {**base, "成交金额": "1", "支付金额": "2"}),
            (2, 7, 3, "s", {**base}),
        ],
        "import_file_id int, shop_id int, row_number int, sheet_name string, raw_payload map<string,string>",
    )
    rows = to_stg_shop_day(scope_import(raw, 1, "s")).orderBy("source_row_number").collect()
    assert [str(r["gross_sales_amount"]) for r in rows] == ["776.03", "1.00"]
    assert (rows[0]["buyer_count"], rows[0]["shop_visitor_count"], rows[0]["product_favorite_user_count"]) == (5, 12, None)
    assert str(rows[0]["refund_amount"]) == "3.01"


@pytest.mark.parametrize(
    ("name", "group"),
    [
        *[(f"①{c.sheet_token}x", "raw-source") for c in DATASETS.values()],
        ("Sheet1", "ignore"),
        (" Sheet12 ", "ignore"),
        ("Sheet1x", "mixed/presentation"),
        ("WpsReserved_CellImgList", "ignore"),
        ("1月日报", "mixed/presentation"),
    ],
)
def test_classify(spark, name, group):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(inv.classify_sheet(F.col("n"))).first()[0] == group


def test_detect_and_choose_sheet(spark):
    sheets = spark.createDataFrame(
        [("a", "①日报数据源"), ("a", "其他"), ("b", "日报数据源1"), ("b", "日报数据源2"), ("c", "其他")], "w string, sheet_name string"
    )
    only = lambda w: sheets.filter(F.col("w") == w)
    assert inv.detect_sheet(only("a"), "日报数据源", ["w"]).first()["sheet_name"] == "①日报数据源"
    with pytest.raises(Exception, match="more than one sheet is named for 日报数据源: 日报数据源1, 日报数据源2"):
        inv.detect_sheet(only("b"), "日报数据源", ["w"]).collect()
    with pytest.raises(Exception, match="no sheet is named for 日报数据源"):
        inv.detect_sheet(only("c"), "日报数据源", ["w"]).collect()
    assert inv.choose_sheet(only("b"), "日报数据源", ["w"], "日报数据源2").first()["sheet_name"] == "日报数据源2"
    with pytest.raises(Exception, match="the workbook has no sheet nope"):
        inv.choose_sheet(only("a"), "日报数据源", ["w"], "nope").collect()


def test_batch_id_is_order_free_and_matches_its_definition(spark):
    pairs = [(f"pdd_{i}_workbook_2026", hashlib.sha256(str(i).encode()).hexdigest()) for i in range(5)]
    schema = "workbook_identifier string, workbook_file_hash string"

    def defined(files):
        parts = {}
        for name, digest in sorted(files):
            parts.setdefault(hashlib.sha256(name.encode()).hexdigest()[:3], []).append(f"{name}|{digest}")
        digests = sorted(hashlib.sha256("\n".join(lines).encode()).hexdigest() for lines in parts.values())
        return hashlib.sha256("\n".join([*digests, "dataset_version=1"]).encode()).hexdigest()[:16]

    for order in (pairs, pairs[::-1]):
        assert inv.batch_id(spark.createDataFrame(order, schema)) == defined(pairs)
    changed = [(p[0], "x" + p[1]) for p in pairs]
    assert inv.batch_id(spark.createDataFrame(changed, schema)) == defined(changed) != defined(pairs)


def test_batch_id_of_very_many_files_follows_the_same_rule(spark):
    files = spark.range(300_000).select(
        F.format_string("pdd_%d_workbook_2026", "id").alias("workbook_identifier"), F.sha2(F.col("id").cast("string"), 256).alias("workbook_file_hash")
    )
    parts = {}
    for r in sorted(files.collect()):
        parts.setdefault(hashlib.sha256(r[0].encode()).hexdigest()[:3], []).append(f"{r[0]}|{r[1]}")
    digests = sorted(hashlib.sha256("\n".join(lines).encode()).hexdigest() for lines in parts.values())
    assert inv.batch_id(files) == hashlib.sha256("\n".join([*digests, "dataset_version=1"]).encode()).hexdigest()[:16]


def test_workbook_identity(spark):
    df = spark.createDataFrame([("/a/pdd_12_workbook_2026.xlsx",)], "p string")
    row = landed.workbook_identity(df, "p").first()
    assert (row["shop_code"], row["workbook_identifier"]) == ("pdd_12", "pdd_12_workbook_2026")
    bad = spark.createDataFrame([("/a/pdd_x_workbook_2026.xlsx",)], "p string")
    with pytest.raises(Exception, match="not a workbook of the family"):
        landed.workbook_identity(bad, "p").collect()


def test_fingerprints(spark, tmp_path):
    (tmp_path / "pdd_1_workbook_2026.xlsx").write_bytes(b"abc")
    row = landed.workbook_files(spark, str(tmp_path / "pdd_*_workbook_2026.xlsx")).first()
    assert row["workbook_file_hash"] == hashlib.sha256(b"abc").hexdigest()
    assert row["shop_code"] == "pdd_1"
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception):
        landed.workbook_files(spark, str(tmp_path / "none" / "pdd_*"))


def test_manifest_rows(spark, sheet, files):
    out = normalize_dataset(sheet, files, SKU_SOURCE, "b1")
    rows = {(r["entry"], r["name"]): r for r in inv.run_manifest(files, inv.dataset_row_counts(out), "b1").collect()}
    assert {k: r["row_count"] for k, r in rows.items() if r["row_count"]} == {("dataset", "sku_source"): 3} and len(rows) == 9
    assert rows["dataset", "spu_source"]["row_count"] == 0 and rows["run", None]["workbook_count"] == 1
    assert rows["workbook", "pdd_1_workbook_2026"]["workbook_file_name"] == "pdd_1_workbook_2026.xlsx"
    resolved = resolve_headers(with_header_positions(sheet.filter("row_number = 1")), SKU_SOURCE, strict=False)
    counts = inv.dataset_row_counts(out, ["dataset_code", "workbook_identifier"])
    manifest = inv.schema_manifest(resolved.withColumn("dataset_code", F.lit("sku_source")), "b1", counts).first()
    assert (manifest["row_count"], manifest["unexpected_headers"]) == (3, ["备注", "颜色"])
    listed = inv.family_inventory(inv.sheet_row_counts(sheet, ["workbook_identifier"]), "b1").first()
    assert (listed["detected_row_count"], listed["sheet_group"]) == (5, "raw-source")
