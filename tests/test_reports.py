import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.operators.windows import latest_date_by, latest_per_group, trailing_days
from salesmart.plans import facts, reporting, reviews

LATEST = dt.date(2025, 3, 31)
SKU_VIEW = (
    "`平台` string, `店铺编码` string, `店铺` string, `日期` date, `商品名称` string, `商品ID` string, `SKU-ID` string, "
    "`商家SKU编码` string, `商品规格` string, `销量` decimal(14,2), `商品总价` decimal(14,2), `商家实收金额` decimal(14,2), `来源行数` int"
)
SPU = (
    "shop_code string, sales_date string, spu_name string, campaign_name string, listing_name string, "
    "product_visitor_count string, product_pageview_count string, unit_count string, buyer_count string, "
    "order_count string, gross_sales_amount string, product_favorite_user_count string"
)


def sku(shop, day, name, spec, net, qty="1"):
    return ("PDD", shop, shop, day, name, "p", "s", None, spec, Decimal(qty), Decimal("1"), net and Decimal(net), 1)


def test_trailing_days_is_thirty_days_inclusive(spark):
    days = [LATEST - dt.timedelta(days=n) for n in (0, 29, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert {r["d"] for r in trailing_days(df, "d", LATEST).collect()} == set(days[:2])
    assert trailing_days(df, "d", None).count() == 0


def test_product_cards(spark):
    early = LATEST - dt.timedelta(days=10)
    rows = [sku("a", LATEST, f"n{i}", None, str(100 - i)) for i in range(8)]
    # A nameless product and one without a total both take a rank; the nameless one is not shown.
    rows += [sku("a", LATEST, None, "x", "500"), sku("a", early, "nul", "y", None), sku("a", early, "n0", "", "1")]
    rows += [sku("b", LATEST, "n0", None, "3"), sku("b", LATEST - dt.timedelta(days=30), "old", None, "999")]
    cards = reporting.product_cards_30d(spark.createDataFrame(rows, SKU_VIEW)).collect()
    got = sorted((r["店铺编码"], r["卡片排序"], r["商品名称"], r["商品规格"], str(r["日期"])) for r in cards if r["商品规格"] is not None)
    assert got == [("a", 1, "nul", "y", str(early)), ("a", 3, "n0", "", str(early))]
    ranks = {(r["店铺编码"], r["卡片排序"], r["商品名称"]) for r in cards}
    assert ranks == {("a", 1, "nul"), ("a", 3, "n0"), ("a", 4, "n1"), ("a", 5, "n2"), ("a", 6, "n3"), ("b", 1, "n0")}


def test_product_cards_limit_ranks_before_the_shuffle(spark):
    df = spark.createDataFrame([sku("a", LATEST, "n", None, "1")], SKU_VIEW)
    plan = reporting.product_cards_30d(df, LATEST)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "dense_rank" in plan and ", 6, Partial" in plan


@pytest.mark.parametrize("limits", [{}, {"single_task_rows": 0, "broadcast_rows": 0}])
def test_sku_rank_ties_and_nulls(spark, limits):
    rows = [sku("a", LATEST, "n1", "1", "5"), sku("a", LATEST, "n2", "2", "5"), sku("b", LATEST, "n3", "3", None, "9")]
    ranked = reporting.sku_rank_30d(spark.createDataFrame(rows, SKU_VIEW), **limits)
    got = {r["商品名称"]: (r["商家实收金额排名"], r["销量排名"]) for r in ranked.collect()}
    assert got == {"n3": (1, 1), "n1": (2, 2), "n2": (2, 2)}


@pytest.fixture(scope="module")
def layers(spark):
    shops = spark.createDataFrame([(1, "s1", None), (2, "s2", "Two")], "shop_id int, shop_code string, shop_name string")
    columns = (
        "import_file_id int, shop_id int, source_row_number int, sales_date date, shop_visitor_count int, "
        "shop_pageview_count int, product_visitor_count int, product_pageview_count int, buyer_count int, order_count int, "
        "gross_sales_amount decimal(14,2), conversion_rate decimal(12,6), avg_order_value decimal(14,2), "
        "uv_value decimal(14,2), product_favorite_user_count int, refund_amount decimal(14,2)"
    )

    def row(imp, shop, n, day, visitors, buyers, sales):
        return (imp, shop, n, day, visitors, 1, 1, 1, buyers, 2, Decimal(sales), None, None, None, 0, None)

    staging = spark.createDataFrame(
        [
            row(1, 1, 2, LATEST, 8804, 481, "14703.36"),
            row(1, 1, 3, dt.date(2025, 2, 1), 0, 3, "9"),
            row(2, 1, 2, LATEST, 100, 10, "50"),
            row(3, 2, 2, dt.date(2025, 1, 5), None, 7, "70"),
        ],
        columns,
    )
    return facts.shop_day_facts(staging), shops, staging


def test_shop_daily_uses_the_loaded_row(layers):
    rows = {(r["店铺编码"], str(r["日期"])): r for r in reporting.shop_daily(*layers).collect()}
    newest = rows[("s1", "2025-03-31")]
    assert (newest["店铺访客数"], newest["转化率"], newest["客单价"]) == (100, Decimal("0.1000"), Decimal("5.00"))
    assert rows[("s1", "2025-02-01")]["转化率"] is None
    assert (rows[("s2", "2025-01-05")]["店铺"], rows[("s1", "2025-02-01")]["店铺"]) == ("Two", "s1")


def test_shop_rank_drops_shops_without_recent_days(layers):
    rows = reporting.shop_rank_30d(reporting.shop_daily(*layers)).collect()
    assert [(r["店铺编码"], r["覆盖天数"], r["成交金额排名"]) for r in rows] == [("s1", 1, 1)]


def test_monthly_and_reviews(layers):
    months = {(r["店铺编码"], r["月份"]): r["覆盖天数"] for r in reporting.shop_monthly(*layers).collect()}
    assert months == {("s1", "2025-03"): 1, ("s1", "2025-02"): 1, ("s2", "2025-01"): 1}
    assert [(r["店铺"], r["月份"]) for r in reviews.review_monthly(*layers).collect()] == sorted(months)
    daily = reviews.review_daily(*layers).collect()
    assert [(r["店铺"], str(r["日期"]), r["导入批次"]) for r in daily] == [
        ("s1", "2025-02-01", 1),
        ("s1", "2025-03-31", 2),
        ("s2", "2025-01-05", 3),
    ]
    assert reporting.top_summary_daily(reporting.shop_daily(*layers)).count() == 3


def spu(shop, day, name="n", campaign=None, visitors="3", buyers="1", sales="10"):
    return (shop, day, name, campaign, "l", visitors, "1.5", "1", buyers, "1", sales, "0")


def test_latest_date_per_shop(spark):
    rows = [spu("a", "2025-01-02"), spu("a", "2025-01-10"), spu("a", None), spu("b", "2025-01-01"), spu("c", None), spu("c", "")]
    df = spark.createDataFrame(rows, SPU)
    assert {r["shop_code"]: r["sales_date"] for r in latest_date_by(df, "shop_code", "sales_date").collect()} == {
        "a": "2025-01-10",
        "b": "2025-01-01",
        "c": None,
    }
    kept = [(r["shop_code"], r["sales_date"]) for r in latest_per_group(df, "shop_code", "sales_date").collect()]
    assert sorted(kept, key=str) == [("a", "2025-01-10"), ("b", "2025-01-01"), ("c", None)]


def test_spu_outputs(spark):
    rows = [
        spu("a", "2025-01-10", "x", None, "200", "1", "776..03"),
        spu("a", "2025-01-10", "x", "", "200", "2", "10.125"),
        spu("a", "2025-01-10", "y", "c", "0", "0", "5"),
        spu("b", "2025-01-01", "z", "c", "x", "1", None),
    ]
    df = spark.createDataFrame(rows, SPU)
    review = [(r["店铺"], r["SPU"], r["商品访客量"], r["商品浏览量"], r["销售额"], r["转化率"], r["客单价"], r["来源行数"]) for r in reviews.review_spu(df).collect()]
    assert review == [
        ("b", "z", "0", "2", "0.00", "0.0000", "0.00", "1"),
        ("a", "x", "400", "3", "10.12", "0.0075", "3.38", "2"),
        ("a", "y", "0", "2", "5.00", "0.0000", "0.00", "1"),
    ]
    snapshot = reviews.spu_snapshot(df, dt.datetime(2026, 1, 1))
    got = {r["spu_name"]: (str(r["gross_sales_amount"]), str(r["derived_conversion_rate"]), r["campaign_name"]) for r in snapshot.collect()}
    assert got == {"x": ("10.13", "0.007500", ""), "y": ("5.00", "0.000000", "c"), "z": ("0.00", "0.000000", "c")}
    cards = reporting.spu_trial_cards(reporting.spu_monitoring(snapshot), single_task_rows=0)
    assert {(r["店铺编码"], r["SPU"]): r["销售额排名"] for r in cards.collect()} == {("a", "x"): 1, ("a", "y"): 2, ("b", "z"): 1}
    manifest = {r["export"]: r["row_count"] for r in reviews.review_manifest(df, df.limit(0), df, dt.datetime(2026, 1, 1)).collect()}
    assert manifest == {"日报_review": 4, "月报_review": 0, "SPU监控_review": 4}


def test_snapshot_needs_a_date(spark):
    df = spark.createDataFrame([spu("c", None)], SPU)
    with pytest.raises(Exception, match="No sales date for shop c"):
        reviews.spu_snapshot(df, dt.datetime(2026, 1, 1)).collect()


def test_sku_facts_and_names(spark):
    schema = (
        "import_file_id int, shop_id int, sales_date date, product_name string, product_id string, sku_id string, "
        "merchant_sku_code string, product_specification string, gross_quantity decimal(14,2), "
        "gross_product_amount decimal(14,2), merchant_net_amount decimal(14,2)"
    )
    def row(imp, name, sku_id, net):
        return (imp, 1, LATEST, name, "p", sku_id, None, None, Decimal(1), Decimal(2), Decimal(net))

    staging = spark.createDataFrame([row(1, "a", "s", "1.10"), row(1, "b", "s", "1.10"), row(1, None, None, "5"), row(2, "A", "s", "7")], schema)
    got = {(r["sku_id"], r["import_file_id"]): (str(r["merchant_net_amount"]), r["source_row_count"]) for r in facts.sku_day_facts(staging).collect()}
    assert got == {("s", 2): ("7.00", 1), ("", 1): ("5.00", 1)}
    names = {(r["import_file_id"], r["sku_id"]): r["product_name"] for r in facts.sku_display_name(staging).collect()}
    assert names == {(1, "s"): "b", (1, ""): None, (2, "s"): "A"}
    shops = spark.createDataFrame([(1, "s1", None)], "shop_id int, shop_code string, shop_name string")
    view = {r["SKU-ID"]: r["商品名称"] for r in reporting.sku_daily(facts.sku_day_facts(staging), shops, staging).collect()}
    assert view == {"s": "A", None: None}
    assert facts.sku_day_facts(staging).agg(F.sum("source_row_count")).first()[0] == 2
