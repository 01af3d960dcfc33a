"""Column contracts of the landed sheets, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    headers: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    """Canonical fields of one dataset, each with its accepted headers in priority order."""

    code: str
    sheet_token: str
    grain: str
    fields: tuple[Field, ...]
    role: str = ""

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def headers_of(self, name: str) -> tuple[str, ...]:
        return next(f.headers for f in self.fields if f.name == name)


def _fields(*items: tuple[str, ...]) -> tuple[Field, ...]:
    return tuple(Field(name, tuple(headers)) for name, *headers in items)


# ---------------------------------------------------------------------------
# Codes, sheet tokens, grains, headers and their priority.
# ---------------------------------------------------------------------------
DATASET_VERSION = 1

SPU_SOURCE = Contract(
    "spu_source",
    "SPU源数据",
    "spu_day",
    _fields(
        ("sales_date", "日期"),
        ("spu_name", "SPU"),
        ("campaign_name", "计划名"),
        ("listing_name", "链接名称"),
        ("product_visitor_count", "商品访客量"),
        ("product_pageview_count", "商品浏览量"),
        ("unit_count", "支付件数", "成交件数"),
        ("buyer_count", "支付买家数", "成交买家数"),
        ("order_count", "支付订单数", "成交订单数"),
        ("gross_sales_amount", "支付金额", "成交金额"),
        ("conversion_rate", "支付转化率", "成交转化率"),
        ("order_rate", "下单率"),
        ("payment_rate", "支付率", "成交率"),
        ("product_favorite_user_count", "商品收藏用户数"),
        ("week_number", "周数"),
        ("week_sales_amount", "周销售额"),
        ("month_number", "月数"),
    ),
)
SKU_SOURCE = Contract(
    "sku_source",
    "SKU源数据",
    "sku_day",
    _fields(
        ("sales_date", "日期"),
        ("product_name", "商品"),
        ("product_id", "商品id"),
        ("merchant_sku_code", "商家编码-SKU维度"),
        ("product_specification", "商品规格"),
        ("quantity_units", "商品数量(件)"),
        ("gross_product_amount", "商品总价(元)"),
        ("merchant_net_amount", "商家实收金额（元）", "商家实收金额(元)"),
        ("sku_id", "SKU-ID"),
    ),
)
SHOP_DAILY_SOURCE = Contract(
    "shop_daily_source",
    "日报数据源",
    "shop_day",
    _fields(
        ("sales_date", "日期"),
        ("shop_visitor_count", "店铺访客数"),
        ("shop_pageview_count", "店铺浏览量"),
        ("product_visitor_count", "商品访客数"),
        ("product_pageview_count", "商品浏览数"),
        ("buyer_count", "支付买家数", "成交买家数"),
        ("order_count", "支付订单数", "成交订单数"),
        ("gross_sales_amount", "支付金额", "成交金额"),
        ("conversion_rate", "支付转化率", "成交转化率"),
        ("avg_order_value", "客单价"),
        ("uv_value", "UV价值"),
        ("product_favorite_user_count", "商品收藏用户数"),
        ("product_favorite_rate", "商品收藏率"),
        ("shop_rating_text", "店铺评分（1/23店铺评价分排名）", "店铺评分"),
        ("refund_amount", "退款金额"),
    ),
)
PROMOTION_TOTAL_SOURCE = Contract(
    "promotion_total_source",
    "推广数据源（总）",
    "shop_day",
    _fields(
        ("sales_date", "日期"),
        ("ad_spend_amount", "花费(元)"),
        ("ad_transaction_amount", "交易额(元)"),
        ("return_on_ad_spend", "投入产出比"),
        ("order_count", "成交笔数"),
        ("cost_per_order", "每笔成交花费(元)"),
        ("amount_per_order", "每笔成交金额(元)"),
        ("impression_count", "曝光量"),
        ("click_count", "点击量"),
        ("total_spend_label", "总花费"),
        ("total_transactions_label", "总成交"),
    ),
)
PROMOTION_CAMPAIGN_SOURCE = Contract(
    "promotion_campaign_source",
    "推广数据源（单）",
    "spu_day",
    _fields(
        ("spu_name", "spu"),
        ("campaign_name", "计划名"),
        ("sales_date", "日期"),
        ("ad_spend_amount", "花费(元)"),
        ("ad_transaction_amount", "交易额(元)"),
        ("return_on_ad_spend", "投入产出比"),
        ("order_count", "成交笔数"),
        ("cost_per_order", "每笔成交花费(元)"),
        ("amount_per_order", "每笔成交金额(元)"),
        ("impression_count", "曝光量"),
        ("click_count", "点击量"),
        ("click_through_rate", "点击率"),
        ("click_conversion_rate", "点击转化率"),
        ("direct_transaction_amount", "直接交易额（元）"),
        ("indirect_transaction_amount", "间接交易额（元）"),
        ("direct_order_count", "直接成交笔数"),
        ("indirect_order_count", "间接成交笔数"),
    ),
)
SHOP_PRODUCT_SOURCE = Contract(
    "shop_product_source",
    "店铺商品信息",
    "product_sku_snapshot",
    _fields(
        ("product_name", "商品名称"),
        ("product_spu_id", "商品SPU -ID"),
        ("product_specification", "商品规格"),
        ("merchant_sku_code", "商家编码-SKU维度"),
        ("product_sku_id", "商品SKU-ID"),
    ),
)
PRODUCT_RATING_SOURCE = Contract(
    "product_rating_source",
    "商品评分数据源",
    "product_day",
    _fields(
        ("sales_date", "日期"),
        ("product_id", "ID"),
        ("review_count", "评价总数"),
        ("product_dsr", "商品DSR"),
        ("description_score", "描述相符评分"),
        ("logistics_score", "物流服务评分"),
        ("service_score", "服务态度评分"),
    ),
)

# The two strict loader contracts list the 成交 family first, the tolerant ones 支付 first.
SHOP_DAILY_LOAD = Contract(
    "pdd_shop_daily",
    "日报数据源",
    "shop_day",
    _fields(
        ("sales_date", "日期"),
        ("shop_visitor_count", "店铺访客数"),
        ("shop_pageview_count", "店铺浏览量"),
        ("product_visitor_count", "商品访客数"),
        ("product_pageview_count", "商品浏览数"),
        ("buyer_count", "成交买家数", "支付买家数"),
        ("order_count", "成交订单数", "支付订单数"),
        ("gross_sales_amount", "成交金额", "支付金额"),
        ("conversion_rate", "成交转化率", "支付转化率"),
        ("avg_order_value", "客单价"),
        ("uv_value", "UV价值"),
        ("product_favorite_user_count", "商品收藏用户数"),
        ("refund_amount", "退款金额"),
    ),
    role="shop_daily_source",
)
SKU_DAILY_LOAD = Contract(
    "pdd_sku_daily",
    "SKU源数据",
    "sku_day",
    _fields(
        ("sales_date", "日期"),
        ("product_name", "商品"),
        ("product_id", "商品id"),
        ("merchant_sku_code", "商家编码-SKU维度"),
        ("product_specification", "商品规格"),
        ("gross_quantity", "商品数量(件)"),
        ("gross_product_amount", "商品总价(元)"),
        ("merchant_net_amount", "商家实收金额（元）", "商家实收金额(元)"),
        ("sku_id", "SKU-ID"),
    ),
    role="sku_daily_source",
)

LINEAGE_TYPES = {
    "batch_id": "string",
    "dataset_version": "bigint",
    "dataset_code": "string",
    "grain_code": "string",
    "workbook_identifier": "string",
    "workbook_path": "string",
    "workbook_file_name": "string",
    "workbook_file_hash": "string",
    "shop_code": "string",
    "sheet_name": "string",
    "sheet_index": "bigint",
    "source_row_number": "bigint",
    "source_header_variant": "string",
    "source_extra_payload_json": "string",
}

# Seed rows for the registry of source types: code, name, grain, description.
SOURCE_TYPE_SEEDS = (
    (
        "pdd_shop_daily",
        "PDD Shop Daily Sales",
        "shop_day",
        "Pinduoduo shop daily Excel export loaded into raw rows, PDD staging, and canonical shop-day facts.",
    ),
    (
        "pdd_sku_daily",
        "PDD SKU Daily Sales",
        "sku_day",
        "Pinduoduo workbook SKU source export loaded into raw rows, PDD SKU staging, and canonical SKU-day facts.",
    ),
    (
        "pdd_workbook_spu_source",
        "PDD Workbook SPU Source",
        "spu_day",
        "Recurring PDD workbook raw SPU source sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_sku_source",
        "PDD Workbook SKU Source",
        "sku_day",
        "Recurring PDD workbook raw SKU source sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_shop_daily_source",
        "PDD Workbook Shop Daily Source",
        "shop_day",
        "Recurring PDD workbook raw shop daily source sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_promo_total_source",
        "PDD Workbook Promotion Total Source",
        "shop_day",
        "Recurring PDD workbook raw promotion total sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_promo_campaign_source",
        "PDD Workbook Promotion Campaign Source",
        "spu_day",
        "Recurring PDD workbook raw promotion campaign sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_shop_product_source",
        "PDD Workbook Shop Product Source",
        "product_sku_snapshot",
        "Recurring PDD workbook raw shop product info sheet normalized into parquet.",
    ),
    (
        "pdd_workbook_product_rating_source",
        "PDD Workbook Product Rating Source",
        "product_day",
        "Recurring PDD workbook raw product rating sheet normalized into parquet.",
    ),
)
# ---------------------------------------------------------------------------

DATASETS: dict[str, Contract] = {
    c.code: c
    for c in (
        SPU_SOURCE,
        SKU_SOURCE,
        SHOP_DAILY_SOURCE,
        PROMOTION_TOTAL_SOURCE,
        PROMOTION_CAMPAIGN_SOURCE,
        SHOP_PRODUCT_SOURCE,
        PRODUCT_RATING_SOURCE,
    )
}

# Canonical columns shared by all datasets, in order of first appearance.
CANONICAL_COLUMNS: list[str] = list(
    dict.fromkeys(name for contract in DATASETS.values() for name in contract.field_names)
)
DATASET_COLUMNS: list[str] = [*LINEAGE_TYPES, *CANONICAL_COLUMNS]
