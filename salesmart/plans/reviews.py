"""Review exports and the product monitoring snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_excel_date, fixed_text, key_text, lenient_decimal, month_label, ratio_or_zero, safe_ratio
from ..operators.windows import latest_per_group
from .reporting import SHOP_MEASURES, monthly_totals, shop_day_base

# Labels, notes and column names of the exports.
DAILY_KIND = ("日报", "经营复盘表", "基于当前店铺日事实层和店铺日分层指标重建，暂未补齐推广明细和部分口碑展示字段。")
MONTHLY_KIND = ("月报", "月度管理汇总", "按当前店铺日事实层月度汇总生成，店铺关注用户数和推广拆分字段暂未完整建模。")
SPU_KIND = (
    "SPU监控",
    "经营巡检面",
    "基于标准化 SPU源数据 生成的临时监控视图，未复刻原始图片和矩阵排版，可作为下一步 SPU 决策层的过渡输出。",
)
SPU_METRICS = {
    "product_visitor_count": "商品访客量",
    "product_pageview_count": "商品浏览量",
    "unit_count": "销量",
    "buyer_count": "买家数",
    "order_count": "订单数",
    "gross_sales_amount": "销售额",
    "product_favorite_user_count": "商品收藏用户数",
}
SPU_KEYS = ["shop_code", "sales_date", "spu_name", "campaign_name", "listing_name"]


def review_daily(fact: DataFrame, shops: DataFrame, staging: DataFrame) -> DataFrame:
    """Derived ratios beside the ratios found in the source, with row lineage, sorted."""
    kind, position, note = DAILY_KIND
    source = ["conversion_rate", "avg_order_value", "uv_value"]
    rows = shop_day_base(fact, shops, staging, source)
    visitors, buyers, sales = F.col("shop_visitor_count"), F.col("buyer_count"), F.col("gross_sales_amount")
    return rows.orderBy("shop_code", "sales_date").select(
        F.lit(kind).alias("报表类型"),
        F.lit(position).alias("报表定位"),
        F.col("shop_code").alias("店铺"),
        F.col("sales_date").alias("日期"),
        *[F.col(c).alias(label) for c, label in SHOP_MEASURES.items()],
        safe_ratio(buyers, visitors, 4).alias("推导转化率"),
        F.col("conversion_rate").alias("源表转化率"),
        safe_ratio(sales, buyers, 2).alias("推导客单价"),
        F.col("avg_order_value").alias("源表客单价"),
        safe_ratio(sales, visitors, 2).alias("推导UV价值"),
        F.col("uv_value").alias("源表UV价值"),
        F.col("import_file_id").alias("导入批次"),
        F.col("source_row_number").alias("来源行号"),
        F.lit(note).alias("说明"),
    )


def review_monthly(fact: DataFrame, shops: DataFrame, staging: DataFrame) -> DataFrame:
    """Month totals by shop code alone, sorted."""
    kind, position, note = MONTHLY_KIND
    rows = monthly_totals(fact, shops, staging, ["shop_code"])
    visitors, buyers, sales = F.col("shop_visitor_count"), F.col("buyer_count"), F.col("gross_sales_amount")
    return rows.orderBy("shop_code", "month").select(
        F.lit(kind).alias("报表类型"),
        F.lit(position).alias("报表定位"),
        F.col("shop_code").alias("店铺"),
        month_label(F.col("month")).alias("月份"),
        F.col("day_count").alias("覆盖天数"),
        *[F.col(c).alias(label) for c, label in SHOP_MEASURES.items()],
        safe_ratio(sales, buyers, 2).alias("推导客单价"),
        safe_ratio(buyers, visitors, 4).alias("推导转化率"),
        safe_ratio(sales, visitors, 2).alias("推导UV价值"),
        F.lit(note).alias("说明"),
    )


def spu_totals(spu_source: DataFrame) -> DataFrame:
    """Metrics per product, campaign and listing on each shop's latest date, at full precision."""
    rows = latest_per_group(
        spu_source.select("shop_code", "sales_date", "spu_name", "campaign_name", "listing_name", *SPU_METRICS),
        "shop_code",
        "sales_date",
    )
    return rows.groupBy(
        "shop_code",
        "sales_date",
        *[key_text(F.col(c)).alias(c) for c in ("spu_name", "campaign_name", "listing_name")],
    ).agg(
        *[F.sum(lenient_decimal(F.col(c))).alias(c) for c in SPU_METRICS],
        F.count(F.lit(1)).alias("source_row_count"),
    )


def review_spu(spu_source: DataFrame) -> DataFrame:
    """Fixed-place text, ties to even, zero where a ratio has no denominator; newest and largest first."""
    kind, position, note = SPU_KIND
    totals = spu_totals(spu_source)
    texts = {
        label: fixed_text(F.col(c), 2 if c == "gross_sales_amount" else 0) for c, label in SPU_METRICS.items()
    }
    buyers, visitors, sales = F.col("buyer_count"), F.col("product_visitor_count"), F.col("gross_sales_amount")
    order = [
        F.col("shop_code").desc(),
        F.col("sales_date").desc(),
        F.bround("gross_sales_amount", 2).desc(),
        "spu_name",
        "campaign_name",
        "listing_name",
    ]
    return totals.orderBy(*order).select(
        F.lit(kind).alias("报表类型"),
        F.lit(position).alias("报表定位"),
        F.col("shop_code").alias("店铺"),
        F.col("sales_date").alias("日期"),
        F.col("spu_name").alias("SPU"),
        F.col("campaign_name").alias("计划名"),
        F.col("listing_name").alias("链接名称"),
        *[t.alias(label) for label, t in texts.items()],
        ratio_or_zero(buyers, visitors, 4, half_even=True).cast("string").alias("转化率"),
        ratio_or_zero(sales, buyers, 2, half_even=True).cast("string").alias("客单价"),
        F.col("source_row_count").cast("string").alias("来源行数"),
        F.lit(note).alias("说明"),
    )


def spu_snapshot(spu_source: DataFrame, refreshed_at: dt.datetime) -> DataFrame:
    """Monitoring snapshot: summed at full precision, rounded half away from zero on load.

    An undated row reaches the result only for a shop without any date, and then
    fails the job, because the snapshot's date must not be NULL.
    """
    totals = spu_totals(spu_source)
    buyers, visitors, sales = F.col("buyer_count"), F.col("product_visitor_count"), F.col("gross_sales_amount")
    undated = F.raise_error(F.concat(F.lit("No sales date for shop "), F.col("shop_code"))).cast("date")
    return totals.orderBy(*SPU_KEYS).select(
        "shop_code",
        F.coalesce(clean_excel_date(F.col("sales_date")), undated).alias("sales_date"),
        "spu_name",
        "campaign_name",
        "listing_name",
        *[F.col(c).cast("decimal(14,2)").alias(c) for c in SPU_METRICS],
        ratio_or_zero(buyers, visitors, 6, half_even=False).cast("decimal(12,6)").alias("derived_conversion_rate"),
        ratio_or_zero(sales, buyers, 2, half_even=False).cast("decimal(14,2)").alias("derived_avg_order_value"),
        F.col("source_row_count").cast("int").alias("source_row_count"),
        F.lit(refreshed_at.replace(tzinfo=None)).cast("timestamp_ntz").alias("refreshed_at"),
    )


def review_manifest(daily: DataFrame, monthly: DataFrame, spu: DataFrame, generated_at: dt.datetime) -> DataFrame:
    """Row count and source layer of each export."""
    # Export names and their source layers.
    layers = {
        "日报_review": (daily, "fact_shop_day_sales + stg_pdd_shop_day_sales"),
        "月报_review": (monthly, "monthly aggregation over current shop-day layer"),
        "SPU监控_review": (spu, "normalized processed parquet from SPU源数据"),
    }
    parts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("export"),
            "row_count",
            F.lit(layer).alias("source_layer"),
            F.lit(generated_at.isoformat(timespec="seconds")).alias("generated_at"),
        )
        for name, (rows, layer) in layers.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
