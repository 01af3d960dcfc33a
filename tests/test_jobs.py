import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from salesmart.contracts import DATASETS, SHOP_DAILY_LOAD
from salesmart.operators.inventory import batch_id
from salesmart.plans import jobs
from salesmart.plans import reporting
from salesmart.sources import sinks

CELLS = "workbook_identifier string, sheet_name string, sheet_index int, row_number int, cells map<int,string>"
NOW, LATER = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
BOOK = "pdd_1_workbook_2026"

SHOP_ROWS = [["45658", "10", "1", "1", "1", "2", "2", "776..03", "0.2", "", "", "3", ""]]
SKU_ROWS = [["45658", "A", "p", "c", "", "1", "2.50", "2", "s"]] * 2


def sheet(spark, rows, name, index):
    data = [(BOOK, name, index, n, dict(enumerate(r))) for n, r in enumerate(rows, 1)]
    return spark.createDataFrame(data, CELLS)


def workbook(spark, shop_rows, sku_rows):
    shop = [[f.headers[0] for f in SHOP_DAILY_LOAD.fields], *shop_rows]
    parts = []
    for i, contract in enumerate(DATASETS.values(), 1):
        rows = [[f.headers[0] for f in contract.fields]]
        if contract.code == "shop_daily_source":
            rows = shop
        elif contract.code == "sku_source":
            rows += sku_rows
        elif contract.code == "spu_source":
            rows += [["45658", "x", "", "l", "4", "5", "1", "1", "1", "10", "", "", "", "0"]]
        parts.append(sheet(spark, rows, f"①{contract.sheet_token}", i))
    parts.append(sheet(spark, [["note"]], "Sheet9", 9))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def book(rows, **changes):
    values = {"rows": rows, "path": f"/in/{BOOK}.xlsx", "file_hash": "h", "shop_code": "pdd_1", "shop_name": "One"}
    return jobs.Workbook(**{**values, **changes})


def test_load_reload_and_report(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    jobs.initialise(spark, wh)
    assert jobs.control_table(spark, wh, "source_file_types", jobs.FILE_TYPES).count() == 9
    first = workbook(spark, SHOP_ROWS, SKU_ROWS)
    shown = jobs.preview_workbook(book(first), SHOP_DAILY_LOAD).first()
    assert (shown["sales_date"], shown["gross_sales_amount"]) == ("2025-01-01", "776..03")
    jobs.load_shop_day(spark, wh, book(first), NOW)
    jobs.load_sku_day(spark, wh, book(first), NOW)
    second = workbook(spark, [["45689", "5", "1", "1", "1", "1", "1", "9", "", "", "", "", ""]], SKU_ROWS[:1])
    jobs.load_shop_day(spark, wh, book(second, shop_name="Two"), LATER)
    jobs.load_sku_day(spark, wh, book(second, shop_name="Two"), LATER)

    files = jobs.layer(spark, wh, "import_files").orderBy("import_file_id").collect()
    assert [(f["import_file_id"], f["shop_id"], f["row_count_raw"]) for f in files] == [(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 1, 1)]
    assert jobs.layer(spark, wh, "import_file_sheets").count() == 32
    assert jobs.layer(spark, wh, "raw_import_rows").count() == 5
    shops = jobs.control_table(spark, wh, "shops", jobs.SHOPS)
    assert [(r["shop_id"], r["shop_name"], r["created_at"]) for r in shops.collect()] == [(1, "Two", NOW)]

    shop_fact, sku_fact = jobs.layer(spark, wh, "fact_shop_day"), jobs.layer(spark, wh, "fact_sku_day")
    got = {str(r["sales_date"]): (str(r["gross_sales_amount"]), r["import_file_id"], r["created_at"]) for r in shop_fact.collect()}
    assert got == {"2025-01-01": ("776.03", 1, NOW), "2025-02-01": ("9.00", 3, LATER)}
    row = sku_fact.first()
    assert (str(row["gross_product_amount"]), row["source_row_count"], row["import_file_id"], row["created_at"]) == ("2.50", 1, 4, NOW)
    view = reporting.shop_daily(shop_fact, shops, jobs.layer(spark, wh, "stg_shop_day")).collect()
    assert sorted((r["店铺"], r["店铺访客数"]) for r in view) == [("Two", 5), ("Two", 10)]
    names = reporting.sku_daily(sku_fact, shops, jobs.layer(spark, wh, "stg_sku_day")).collect()
    assert [(r["商品名称"], r["来源行数"]) for r in names] == [("A", 1)]


def test_bad_input_leaves_no_trace(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    bad = [list(SHOP_ROWS[0]), list(SHOP_ROWS[0])]
    with pytest.raises(ValueError, match="date occurs twice"):
        jobs.load_shop_day(spark, wh, book(workbook(spark, bad, SKU_ROWS)), NOW)
    bad = [[*SHOP_ROWS[0][:-1], "oops"]]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jobs.load_shop_day(spark, wh, book(workbook(spark, bad, SKU_ROWS)), NOW)
    assert jobs.layer(spark, wh, "import_files", jobs.IMPORT_FILES).count() == 0


def test_family_snapshot_and_reviews(spark, tmp_path):
    rows = workbook(spark, SHOP_ROWS, SKU_ROWS)
    files = spark.createDataFrame(
        [(BOOK, f"/in/{BOOK}.xlsx", f"{BOOK}.xlsx", "h", "pdd_1")],
        "workbook_identifier string, workbook_path string, workbook_file_name string, workbook_file_hash string, shop_code string",
    )
    family = str(tmp_path / "family")
    target = jobs.build_family(spark, rows, files, family)
    assert target.endswith("version=1")
    assert jobs.family_dataset(spark, family, "sku_source").count() == 2
    manifest = {r["name"]: r["row_count"] for r in spark.read.json(f"{target}/run_manifest").collect()}
    assert manifest["sku_source"] == 2 and manifest[BOOK] is None and manifest["product_rating_source"] == 0
    assert {r["batch_id"] for r in spark.read.parquet(f"{target}/sheet_inventory").collect()} == {batch_id(files)}
    schema = spark.read.json(f"{target}/schema_manifests").filter("dataset_code = 'shop_daily_source'").first()
    assert (schema["row_count"], schema["missing_headers"]) == (1, ["商品收藏率"])
    assert len(spark.read.json(f"{target}/sheet_classification").first()["sheets"]) == 8

    jobs.refresh_monitoring(spark, family, str(tmp_path / "snapshot"), NOW)
    snapshot = sinks.read_published(spark, str(tmp_path / "snapshot")).first()
    assert (snapshot["spu_name"], str(snapshot["derived_conversion_rate"]), snapshot["refreshed_at"]) == ("x", "0.250000", NOW)

    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    jobs.load_shop_day(spark, wh, book(rows), NOW)
    out = jobs.export_reviews(spark, wh, family, str(tmp_path / "reviews"), NOW)
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{out}/日报_review/*.csv"))
    assert text.splitlines()[1].startswith("日报,经营复盘表,pdd_1,2025-01-01,10,1,1,1,2,2,776.03,,3,0.2000,0.200000")
    exported = {r["export"]: r["row_count"] for r in spark.read.json(f"{out}/run_manifest").collect()}
    assert exported == {"日报_review": 1, "月报_review": 1, "SPU监控_review": 1}
    broken = rows.filter(~F.contains(F.col("sheet_name"), F.lit("SKU源数据")))
    with pytest.raises(ValueError, match="sku_source"):
        jobs.build_family(spark, broken, files, family)
