"""The nine reporting views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import key_display, key_text, month_label, month_start, safe_ratio
from ..operators.joins import current_version, with_display_name, with_shop
from ..operators.ranking import Order, Rank, dense_ranks
from ..operators.windows import latest_date, trailing_days
from .facts import sku_display_name

# Labels that appear in the views.
PLATFORM_LABEL = "PDD"
WINDOW_LABEL = "近30天"
TRIAL_STATUS = "试运行"
TRIAL_NOTE = "试运行预览：基于标准化 SPU源数据 生成，供 Metabase 预览使用，暂不视为正式事实层。"

TRAFFIC = [
    "shop_visitor_count",
    "shop_pageview_count",
    "product_visitor_count",
    "product_pageview_count",
    "product_favorite_user_count",
]
# Column names of the shop views, in output order.
SHOP_MEASURES = {
    "shop_visitor_count": "店铺访客数",
    "shop_pageview_count": "店铺浏览量",
    "product_visitor_count": "商品访客数",
    "product_pageview_count": "商品浏览数",
    "buyer_count": "买家数",
    "order_count": "订单数",
    "gross_sales_amount": "成交金额",
    "refund_amount": "退款金额",
    "product_favorite_user_count": "商品收藏用户数",
}
# Column names of the SKU views.
SKU_MEASURES = {
    "gross_quantity": "销量",
    "gross_product_amount": "商品总价",
    "merchant_net_amount": "商家实收金额",
}


def shop_day_base(fact: DataFrame, shops: DataFrame, staging: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Shop-day facts with shop names and the traffic columns of the row they were loaded from."""
    return current_version(with_shop(fact, shops), staging, [*TRAFFIC, *(extra or [])])


def _shop_ratios(buyers: Column, sales: Column, visitors: Column) -> list[Column]:
    return [
        safe_ratio(buyers, visitors, 4).alias("转化率"),
        safe_ratio(sales, buyers, 2).alias("客单价"),
        safe_ratio(sales, visitors, 2).alias("UV价值"),
    ]


def _sums(columns: dict[str, str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _renamed(columns: dict[str, str]) -> list[Column]:
    return [F.col(c).alias(label) for c, label in columns.items()]


def _ratios_of_columns() -> list[Column]:
    return _shop_ratios(F.col("buyer_count"), F.col("gross_sales_amount"), F.col("shop_visitor_count"))


def shop_daily(fact: DataFrame, shops: DataFrame, staging: DataFrame) -> DataFrame:
    return shop_day_base(fact, shops, staging).select(
        F.lit(PLATFORM_LABEL).alias("平台"),
        F.col("shop_code").alias("店铺编码"),
        F.col("shop_name").alias("店铺"),
        F.col("sales_date").alias("日期"),
        *_renamed(SHOP_MEASURES),
        *_ratios_of_columns(),
    )


def monthly_totals(fact: DataFrame, shops: DataFrame, staging: DataFrame, by: list[str]) -> DataFrame:
    """Month totals by shop labels; summed per shop id first, so the names join small rows."""
    per_id = (
        current_version(fact, staging, TRAFFIC)
        .groupBy("shop_id", month_start(F.col("sales_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("day_count"), *_sums(SHOP_MEASURES))
    )
    return (
        with_shop(per_id, shops)
        .groupBy(*by, "month")
        .agg(F.sum("day_count").alias("day_count"), *_sums(SHOP_MEASURES))
    )


def shop_monthly(fact: DataFrame, shops: DataFrame, staging: DataFrame) -> DataFrame:
    return monthly_totals(fact, shops, staging, ["shop_code", "shop_name"]).select(
        F.lit(PLATFORM_LABEL).alias("平台"),
        F.col("shop_code").alias("店铺编码"),
        F.col("shop_name").alias("店铺"),
        month_label(F.col("month")).alias("月份"),
        F.col("day_count").alias("覆盖天数"),
        *_renamed(SHOP_MEASURES),
        *_ratios_of_columns(),
    )


def sku_day_base(fact: DataFrame, shops: DataFrame, staging: DataFrame | None = None) -> DataFrame:
    """SKU-day facts with shop and product names; only facts stored without their names need ``staging``."""
    named = fact if "product_name" in fact.columns else with_display_name(fact, sku_display_name(staging))
    return with_shop(named, shops)


def sku_daily(fact: DataFrame, shops: DataFrame, staging: DataFrame | None = None) -> DataFrame:
    return sku_day_base(fact, shops, staging).select(
        F.lit(PLATFORM_LABEL).alias("平台"),
        F.col("shop_code").alias("店铺编码"),
        F.col("shop_name").alias("店铺"),
        F.col("sales_date").alias("日期"),
        F.col("product_name").alias("商品名称"),
        key_display(F.col("product_id")).alias("商品ID"),
        key_display(F.col("sku_id")).alias("SKU-ID"),
        key_display(F.col("merchant_sku_code")).alias("商家SKU编码"),
        key_display(F.col("product_specification")).alias("商品规格"),
        *_renamed(SKU_MEASURES),
        F.col("source_row_count").alias("来源行数"),
    )


def spu_monitoring(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        F.lit(PLATFORM_LABEL).alias("平台"),
        F.lit(TRIAL_STATUS).alias("状态"),
        F.col("shop_code").alias("店铺编码"),
        F.col("shop_code").alias("店铺"),
        F.col("sales_date").alias("日期"),
        F.col("spu_name").alias("SPU"),
        key_display(F.col("campaign_name")).alias("计划名"),
        key_display(F.col("listing_name")).alias("链接名称"),
        F.col("product_visitor_count").alias("商品访客量"),
        F.col("product_pageview_count").alias("商品浏览量"),
        F.col("unit_count").alias("销量"),
        F.col("buyer_count").alias("买家数"),
        F.col("order_count").alias("订单数"),
        F.col("gross_sales_amount").alias("销售额"),
        F.col("product_favorite_user_count").alias("商品收藏用户数"),
        F.col("derived_conversion_rate").alias("转化率"),
        F.col("derived_avg_order_value").alias("客单价"),
        F.col("source_row_count").alias("来源行数"),
        F.col("refreshed_at").alias("刷新时间"),
        F.lit(TRIAL_NOTE).alias("说明"),
    )


def top_summary_daily(shop_daily_view: DataFrame) -> DataFrame:
    labels = list(SHOP_MEASURES.values())
    totals = shop_daily_view.groupBy("平台", "日期").agg(
        F.count_distinct("店铺编码").alias("覆盖店铺数"), *[F.sum(c).alias(c) for c in labels]
    )
    return totals.select(
        "平台",
        "日期",
        "覆盖店铺数",
        *labels,
        *_shop_ratios(F.col("买家数"), F.col("成交金额"), F.col("店铺访客数")),
    )


def shop_rank_30d(shop_daily_view: DataFrame, latest: dt.date | None = None, **limits: int) -> DataFrame:
    """Totals of the trailing 30 days per shop with two global ranks.

    ``latest`` is the view's latest date; pass it when it is already known.
    """
    latest = latest or latest_date(shop_daily_view, "日期")
    labels = ["店铺访客数", "买家数", "订单数", "成交金额", "退款金额"]
    totals = (
        trailing_days(shop_daily_view, "日期", latest)
        .groupBy("平台", "店铺编码", "店铺")
        .agg(F.count(F.lit(1)).alias("覆盖天数"), *[F.sum(c).alias(c) for c in labels])
    )
    ranked = dense_ranks(
        totals,
        [
            Rank("成交金额排名", (Order("成交金额", descending=True),)),
            Rank("买家数排名", (Order("买家数", descending=True),)),
        ],
        **limits,
    )
    return ranked.select(
        F.lit(WINDOW_LABEL).alias("统计窗口"),
        "平台",
        "店铺编码",
        "店铺",
        "覆盖天数",
        *labels,
        *_shop_ratios(F.col("买家数"), F.col("成交金额"), F.col("店铺访客数")),
        "成交金额排名",
        "买家数排名",
    )


def sku_rank_30d(sku_daily_view: DataFrame, latest: dt.date | None = None, **limits: int) -> DataFrame:
    """Totals of the trailing 30 days per SKU with two ranks over all SKUs."""
    latest = latest or latest_date(sku_daily_view, "日期")
    keys = ["平台", "店铺编码", "店铺", "商品名称", "商品ID", "SKU-ID", "商家SKU编码", "商品规格"]
    labels = [*SKU_MEASURES.values(), "来源行数"]
    totals = (
        trailing_days(sku_daily_view, "日期", latest).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in labels])
    )
    ranked = dense_ranks(
        totals,
        [
            Rank("商家实收金额排名", (Order("商家实收金额", descending=True),)),
            Rank("销量排名", (Order("销量", descending=True),)),
        ],
        **limits,
    )
    return ranked.select(F.lit(WINDOW_LABEL).alias("统计窗口"), *keys, *labels, "商家实收金额排名", "销量排名")


def product_cards_30d(sku_daily_view: DataFrame, latest: dt.date | None = None, k: int = 6) -> DataFrame:
    """Daily series of the first ``k`` products per shop over the trailing 30 days.

    Rows are summed per day first; a product's total is then a window over its
    at most 30 day rows, and the rank filter directly above its window lets
    every task drop all but ``k`` products per shop before the shuffle. A
    product without a name takes a rank but is not shown.
    """
    latest = latest or latest_date(sku_daily_view, "日期")
    labels = list(SKU_MEASURES.values())
    days = (
        trailing_days(sku_daily_view, "日期", latest)
        .groupBy("平台", "店铺编码", "店铺", "商品名称", "商品规格", "日期")
        .agg(*[F.sum(c).alias(c) for c in labels])
        .withColumn("_spec", key_text(F.col("商品规格")))
    )
    product = W.partitionBy("店铺编码", "店铺", "商品名称", "_spec")
    card = W.partitionBy("店铺编码").orderBy(
        F.col("_total").desc_nulls_first(), F.col("商品名称").asc_nulls_last(), F.col("_spec")
    )
    return (
        days.withColumn("_total", F.sum("商家实收金额").over(product))
        .withColumn("卡片排序", F.dense_rank().over(card))
        .filter(F.col("卡片排序") <= k)
        .filter(F.col("商品名称").isNotNull())
        .select(
            F.lit(WINDOW_LABEL).alias("统计窗口"),
            "平台",
            "店铺编码",
            "店铺",
            "卡片排序",
            "商品名称",
            "商品规格",
            "日期",
            *labels,
        )
    )


def spu_trial_cards(spu_view: DataFrame, **limits: int) -> DataFrame:
    """Monitoring rows ranked by sales inside each shop; nothing is filtered out."""
    rank = Rank("销售额排名", (Order("销售额", descending=True), Order("SPU")), partition=("店铺编码",))
    ranked = dense_ranks(spu_view, [rank], **limits)
    first = ["平台", "状态", "店铺编码", "店铺", "日期", "销售额排名"]
    return ranked.select(*first, *[c for c in spu_view.columns if c not in first])
