"""Domain objects derived from the test tables.

Nations act as shops, line items as sales, orders as workbooks, sheets or sheet
rows. All of them grow with the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import DATASETS
from ..functions import safe_ratio
from ..operators.joins import dealt
from ..operators.windows import latest_date, window_start
from ..plans.facts import fact_sku_day, upsert_shop_day, upsert_sku_day
from ..plans.staging import narrow_fact

SECOND_SHOP_IMPORT = dt.date(2000, 1, 1)
SECOND_SKU_IMPORT = dt.date(2001, 1, 1)
DAY_ZERO = dt.date(1994, 12, 31)
IDEOGRAPHIC_SPACE = "　"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table whose rows use all cores also where its files give fewer splits than cores.

        A single small file is one task, however much work follows the scan.
        Large inputs have enough splits and are read as they are.
        """
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def latest_sale(t: Tables) -> dt.date:
    """Latest ship date: one column of one table."""
    return latest_date(t.lineitem, "l_shipdate").date()


def dim_shop(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("shop_id"),
        F.col("n_regionkey").alias("platform_id"),
        F.concat(F.lit("pdd_"), "n_nationkey").alias("shop_code"),
        F.when(F.col("n_nationkey") % 7 != 0, F.col("n_name")).alias("shop_name"),
    )


def _lines_since(t: Tables, since: dt.date | None = None) -> DataFrame:
    lines = t.spread("lineitem")
    if since is not None:
        lines = lines.filter(F.col("l_shipdate") > F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp_ntz"))
    return lines


def sales_lines(t: Tables, since: dt.date | None = None) -> DataFrame:
    """Line items with the shop that sold them; ``since`` prunes the scan."""
    lines = _lines_since(t, since)
    shops = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("shop_id"))
    return lines.join(shops, "l_suppkey").withColumns(
        {
            "sales_date": F.col("l_shipdate").cast("date"),
            "gross": F.col("l_extendedprice").cast("decimal(14,2)"),
        }
    )


def shop_day_clean(t: Tables, since: dt.date | None = None) -> DataFrame:
    """Shop-day measures with traffic; summed per order first, so one distinct count is left.

    Lines and orders are dealt by order before the join, so the per-order sum
    needs no exchange of its own. There are about as many per-order sums as
    lines, so the number of parts, not their size, grows with the lines.
    """
    lines = sales_lines(t, since).select("shop_id", "sales_date", "l_orderkey", "gross", "l_returnflag")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("gross"))
    lines, orders = dealt([lines, orders], ["l_orderkey"], _lines_since(t, since).count())
    per_order = (
        lines.join(orders, "l_orderkey")
        .groupBy("shop_id", "sales_date", "l_orderkey", "o_custkey")
        .agg(F.sum("gross").alias("gross"), F.sum(returned).alias("refund"))
    )
    days = per_order.groupBy("shop_id", "sales_date").agg(
        F.count_distinct("o_custkey").cast("int").alias("buyer_count"),
        F.count(F.lit(1)).cast("int").alias("order_count"),
        F.sum("gross").cast("decimal(14,2)").alias("gross_sales_amount"),
        F.sum("refund").cast("decimal(14,2)").alias("refund_amount"),
    )
    day = F.day("sales_date")
    visitors = (
        F.when(day == 13, F.lit(0))
        .when(day != 17, F.col("buyer_count") * (1 + (F.col("shop_id") + day) % 9))
        .cast("int")
    )
    with_visitors = days.withColumn("shop_visitor_count", visitors)
    buyers, sales, seen = F.col("buyer_count"), F.col("gross_sales_amount"), F.col("shop_visitor_count")
    return with_visitors.withColumns(
        {
            "shop_pageview_count": (seen * 3).cast("int"),
            "product_visitor_count": (seen * 2).cast("int"),
            "product_pageview_count": (seen * 5).cast("int"),
            "product_favorite_user_count": (buyers % 4).cast("int"),
            "conversion_rate": F.when(day == 11, F.lit("4.95").cast("decimal(12,6)")).otherwise(
                safe_ratio(buyers, seen, 4).cast("decimal(12,6)")
            ),
            "avg_order_value": safe_ratio(sales, buyers, 2).cast("decimal(14,2)"),
            "uv_value": F.when(day == 5, F.lit("0.09").cast("decimal(14,2)")).otherwise(
                safe_ratio(sales, seen, 2).cast("decimal(14,2)")
            ),
        }
    )


def shop_day_staging(t: Tables, since: dt.date | None = None) -> DataFrame:
    """Two imports per shop: all days, then a refresh of the even shops with doubled sales."""
    second = (F.col("shop_id") % 2 == 0) & (F.col("sales_date") >= F.lit(SECOND_SHOP_IMPORT))
    imports = F.when(second, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        shop_day_clean(t, since)
        .withColumn("_second", F.explode(imports))
        .withColumns(
            {
                "import_file_id": F.col("shop_id") + 1 + F.col("_second") * 1000,
                "source_row_number": F.date_diff("sales_date", F.lit(DAY_ZERO)) + 1,
                "gross_sales_amount": (F.col("gross_sales_amount") * (F.col("_second") + 1)).cast("decimal(14,2)"),
            }
        )
        .drop("_second")
    )


def shop_day_fact(staging: DataFrame) -> DataFrame:
    first = staging.filter("import_file_id < 1000")
    second = staging.filter("import_file_id >= 1000")
    return upsert_shop_day(narrow_fact(first), second)


def shop_day_raw(t: Tables) -> DataFrame:
    """The first import as messy raw rows: header families, serial dates, padding, doubled points."""
    day, shop = F.day("sales_date"), F.col("shop_id")
    text = lambda c: F.col(c).cast("string")
    padded = lambda c: F.concat(F.lit(IDEOGRAPHIC_SPACE), text(c), F.lit(".0 \t"))
    broken = lambda c: F.when(day % 10 == 3, F.replace(text(c), F.lit("."), F.lit(".."))).otherwise(text(c))
    date_text = (
        F.when(day % 10 == 9, F.date_format("sales_date", "yyyy/M/d"))
        .when(day % 2 == 0, F.concat(F.date_diff("sales_date", F.lit(dt.date(1899, 12, 30))).cast("string"), F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), text("sales_date")))
    )

    def family(suffix: str, value: Column) -> list[Column]:
        deal = F.when(shop % 5 == 0, F.lit(" ")).when(shop % 2 == 0, F.coalesce(value, F.lit("")))
        paid = F.when((shop % 5 == 0) | (shop % 2 == 1), F.coalesce(value, F.lit("")))
        return [F.lit(f"成交{suffix}"), deal, F.lit(f"支付{suffix}"), paid]

    blank = lambda c: F.coalesce(c, F.lit(""))
    payload = F.create_map(
        F.lit("日期"), date_text,
        F.lit("店铺访客数"), blank(padded("shop_visitor_count")),
        F.lit("店铺浏览量"), blank(text("shop_pageview_count")),
        F.lit("商品访客数"), blank(padded("product_visitor_count")),
        F.lit("商品浏览数"), blank(text("product_pageview_count")),
        *family("买家数", padded("buyer_count")),
        *family("订单数", text("order_count")),
        *family("金额", broken("gross_sales_amount")),
        *family("转化率", broken("conversion_rate")),
        F.lit("客单价"), blank(broken("avg_order_value")),
        F.lit("UV价值"), blank(broken("uv_value")),
        F.lit("商品收藏用户数"), blank(F.concat(text("product_favorite_user_count"), F.lit(".9"))),
        F.lit("退款金额"), blank(text("refund_amount")),
    )
    return shop_day_clean(t).select(
        "shop_id",
        (shop + 1).alias("import_file_id"),
        (F.date_diff("sales_date", F.lit(DAY_ZERO)) + 1).alias("row_number"),
        F.lit("①日报数据源").alias("sheet_name"),
        F.map_filter(payload, lambda k, v: v.isNotNull()).alias("raw_payload"),
    )


def _net(gross: Column, discount: Column) -> Column:
    return F.round(gross * (1 - discount.cast("decimal(4,2)")), 2).cast("decimal(14,2)")


def sku_lines(t: Tables, since: dt.date | None = None) -> DataFrame:
    """One row per SKU source row: first lines of an order occur twice."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size")
    key = F.col("l_partkey")
    repeats = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        sales_lines(t, since)
        .join(part, "l_partkey")
        .select(
            "shop_id",
            "sales_date",
            "l_orderkey",
            "l_linenumber",
            F.when(key % 17 != 0, F.col("p_name")).alias("product_name"),
            key.cast("string").alias("product_id"),
            F.concat_ws("-", key, F.col("l_suppkey")).alias("sku_id"),
            F.when(key % 11 != 0, F.col("p_brand")).alias("merchant_sku_code"),
            F.when(key % 13 != 0, F.concat_ws("/", "p_type", "p_size")).alias("product_specification"),
            F.col("l_quantity").cast("decimal(14,2)").alias("gross_quantity"),
            F.col("gross").alias("gross_product_amount"),
            _net(F.col("gross"), F.col("l_discount")).alias("merchant_net_amount"),
            repeats.alias("_repeats"),
        )
        .withColumn("_repeat", F.explode("_repeats"))
        .drop("_repeats", "_repeat")
    )


def sku_staging(t: Tables, since: dt.date | None = None) -> DataFrame:
    """Two imports per shop: all days, then a refresh of recent days with renamed products."""
    second = F.col("sales_date") >= F.lit(SECOND_SKU_IMPORT)
    imports = F.when(second, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        sku_lines(t, since)
        .withColumn("_second", F.explode(imports))
        .withColumns(
            {
                "import_file_id": F.col("shop_id") + 1 + F.col("_second") * 1000,
                "product_name": F.when(F.col("_second") == 1, F.concat("product_name", F.lit(" v2"))).otherwise(
                    F.col("product_name")
                ),
                "gross_quantity": (F.col("gross_quantity") + F.col("_second")).cast("decimal(14,2)"),
            }
        )
        .drop("_second", "l_orderkey", "l_linenumber")
    )


def sku_fact(staging: DataFrame) -> DataFrame:
    first = fact_sku_day(staging.filter("import_file_id < 1000"))
    second = fact_sku_day(staging.filter("import_file_id >= 1000"))
    return upsert_sku_day(first, second)


def sku_raw(t: Tables) -> DataFrame:
    """SKU source rows as raw rows with both spellings of the net amount header."""
    lines = sku_lines(t)
    shop = F.col("shop_id")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    doubled = F.when(
        F.col("l_linenumber") == 3, F.replace(text("gross_product_amount"), F.lit("."), F.lit("..."))
    ).otherwise(text("gross_product_amount"))
    wide = F.when(shop % 2 == 0, text("merchant_net_amount"))
    narrow = F.when(shop % 2 == 1, text("merchant_net_amount"))
    payload = F.create_map(
        F.lit("日期"), F.date_diff("sales_date", F.lit(dt.date(1899, 12, 30))).cast("string"),
        F.lit("商品"), F.concat(F.lit(IDEOGRAPHIC_SPACE), text("product_name")),
        F.lit("商品id"), text("product_id"),
        F.lit("商家编码-SKU维度"), text("merchant_sku_code"),
        F.lit("商品规格"), F.concat(text("product_specification"), F.lit("\n")),
        F.lit("商品数量(件)"), text("gross_quantity"),
        F.lit("商品总价(元)"), doubled,
        F.lit("商家实收金额（元）"), wide,
        F.lit("商家实收金额(元)"), narrow,
        F.lit("SKU-ID"), text("sku_id"),
    )
    return lines.select(
        "shop_id",
        (shop + 1).alias("import_file_id"),
        F.col("l_orderkey").alias("row_number"),
        F.map_filter(payload, lambda k, v: v.isNotNull()).alias("raw_payload"),
    )


def spu_source(t: Tables) -> DataFrame:
    """Product rows dated by year, all metrics as text; some malformed, some without a date."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    lines = sales_lines(t).join(part, "l_partkey")
    gross, line = F.col("gross").cast("string"), F.col("l_linenumber")
    units = F.col("l_quantity").cast("int")
    undated = (line == 5) & (F.col("l_partkey") % 10 == 0)
    return lines.select(
        F.concat(F.lit("pdd_"), "shop_id").alias("shop_code"),
        F.when(~undated, F.trunc("sales_date", "year").cast("string")).alias("sales_date"),
        F.col("p_type").alias("spu_name"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("p_brand")).alias("campaign_name"),
        F.col("l_linestatus").alias("listing_name"),
        (units * 3).cast("string").alias("product_visitor_count"),
        F.concat((units * 7).cast("string"), F.lit(".5")).alias("product_pageview_count"),
        units.cast("string").alias("unit_count"),
        F.when(line != 2, F.lit("1")).otherwise(F.lit("")).alias("buyer_count"),
        F.when(line == 4, F.lit("n/a")).otherwise(F.lit("1")).alias("order_count"),
        F.when(line == 7, F.replace(gross, F.lit("."), F.lit(".."))).otherwise(gross).alias("gross_sales_amount"),
        F.when(line != 3, line.cast("string")).alias("product_favorite_user_count"),
    )


def order_book(t: Tables) -> DataFrame:
    """Orders as workbooks."""
    return t.spread("orders").withColumn("workbook_identifier", F.concat(F.lit("wb_"), "o_orderkey"))


def indexed_map(names: Column) -> Column:
    """Array of header names -> map of column index to name."""
    return F.map_from_entries(F.transform(names, lambda n, i: F.struct(i.alias("key"), n.alias("value"))))


def shop_daily_headers(t: Tables) -> DataFrame:
    """Header rows of the shop-daily sheet, one per order: either family or both, extras, a repeated name."""
    key = F.col("o_orderkey")
    deal = [F.lit(f"成交{s}") for s in ("买家数", "订单数", "金额", "转化率")]
    paid = [F.lit(f"支付{s}") for s in ("买家数", "订单数", "金额", "转化率")]
    start = [F.lit(h) for h in ("日期", " 店铺访客数 ", "店铺浏览量", "商品访客数", "商品浏览数")]
    rest = [F.lit(h) for h in ("客单价", "UV价值", "商品收藏用户数", "退款金额")]
    extra = F.when(key % 4 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))
    names = F.concat(
        F.array(*start),
        F.when(key % 3 == 1, F.array(*paid)).otherwise(F.array(*deal)),
        F.array(*rest, extra),
        F.when(key % 3 == 2, F.array(*paid)).otherwise(F.array().cast("array<string>")),
        F.when(key % 5 == 0, F.array(F.lit("日期"))).otherwise(F.array().cast("array<string>")),
    )
    return order_book(t).select("workbook_identifier", indexed_map(names).alias("cells"))


def spu_headers(t: Tables) -> DataFrame:
    """Header rows of the SPU sheet, one per order, with single- and multi-variant headers left out."""
    key = F.col("o_orderkey")
    names = F.array_compact(
        F.array(
            *[F.lit(h) for h in ("日期", "SPU", "计划名", "链接名称", "商品访客量", "商品浏览量")],
            F.when(key % 2 == 0, F.lit("支付件数")),
            *[F.lit(h) for h in ("支付买家数", "成交订单数", "支付金额", "支付转化率")],
            F.when(key % 3 != 0, F.lit("下单率")),
            F.lit("商品收藏用户数"),
            F.when(key % 5 != 0, F.lit("周数")),
            F.lit("周销售额"),
            F.lit("月数"),
            F.col("o_orderpriority"),
        )
    )
    return order_book(t).select("workbook_identifier", indexed_map(names).alias("cells"))


def order_sheets(t: Tables) -> DataFrame:
    """Sheet lists, one workbook per order: one shop-daily sheet, one SKU sheet, others."""
    sheets = order_book(t).withColumn(
        "sheet_index", F.explode(F.sequence(F.lit(1), (3 + F.col("o_orderkey") % 5).cast("int")))
    )
    return sheets.select("workbook_identifier", "sheet_index", _sheet_name(F.col("sheet_index")).alias("sheet_name"))


def _sheet_name(index: Column) -> Column:
    return (
        F.when(index == 2, F.concat(F.lit("①日报数据源"), F.col("o_orderkey") % 7))
        .when(index == 3, F.lit(" SKU源数据 "))
        .when(index == 4, F.lit("WpsReserved_CellImgList"))
        .when(index == 5, F.concat(F.lit("Sheet"), "o_orderkey"))
        .when(index == 6, F.concat(F.lit("Sheet"), "o_orderkey", F.lit("x")))
        .otherwise(F.concat("o_orderpriority", F.lit("月报"), index))
    )


def order_sheet_rows(t: Tables) -> DataFrame:
    """Line items as rows of the sheets of their order's workbook; many listed sheets have none, some rows lie in sheets that
    are not listed, and some were landed without a number."""
    lines = t.spread("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    named = lines.join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    return named.select(
        F.concat(F.lit("wb_"), "o_orderkey").alias("workbook_identifier"),
        F.col("l_linenumber").alias("sheet_index"),
        _sheet_name(F.col("l_linenumber")).alias("sheet_name"),
        F.when(F.col("l_suppkey") % 9 != 0, (1 + F.col("l_partkey") % 3).cast("int")).alias("row_number"),
    )


def order_files(t: Tables) -> DataFrame:
    """Registered workbooks: most orders, and customers as workbooks without any sheet."""
    book = F.col("workbook_identifier")
    orders = order_book(t).filter("o_orderkey % 7 <> 0").select(book)
    files = orders.unionByName(t.customer.select(F.concat(F.lit("wb_c"), "c_custkey").alias("workbook_identifier")))
    return files.select(
        book,
        F.concat(F.lit("/in/"), book).alias("workbook_path"),
        F.concat(book, F.lit(".xlsx")).alias("workbook_file_name"),
        F.sha2(book, 256).alias("workbook_file_hash"),
        F.concat(F.lit("pdd_"), F.length(book)).alias("shop_code"),
    )


def shop_book(shop_id: Column) -> Column:
    return F.concat(F.lit("pdd_"), shop_id, F.lit("_workbook_2026"))


def line_sheet_rows(t: Tables) -> DataFrame:
    """Line items as sheet rows: one workbook per shop, one sheet per dataset."""
    tokens = F.array(*[F.lit(c.sheet_token) for c in DATASETS.values()])
    codes = F.array(*[F.lit(c) for c in DATASETS])
    index = F.col("l_linenumber")
    return sales_lines(t).select(
        shop_book(F.col("shop_id")).alias("workbook_identifier"),
        index.alias("sheet_index"),
        F.concat(F.lit("①"), F.element_at(tokens, index)).alias("sheet_name"),
        F.element_at(codes, index).alias("dataset_code"),
        F.col("l_orderkey").alias("row_number"),
    )


def sku_sheet_rows(t: Tables) -> DataFrame:
    """SKU sheet of every shop's workbook as rows of cells: a header row per shop, a row per order."""
    shop = F.col("n_nationkey")
    net = F.when(shop % 2 == 0, F.lit("商家实收金额（元）")).otherwise(F.lit("商家实收金额(元)"))
    names = F.array(
        *[F.lit(h) for h in ("日期", "商品", "商品id", "商家编码-SKU维度", "商品规格", "商品数量(件)", "商品总价(元)")],
        net,
        F.lit("SKU-ID"),
        F.lit("备注"),
    )
    sheet = [F.lit("②SKU源数据").alias("sheet_name"), F.lit(2).alias("sheet_index")]
    header = t.nation.select(
        shop_book(shop).alias("workbook_identifier"), *sheet, F.lit(1).alias("row_number"), indexed_map(names).alias("cells")
    )
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    serial = F.date_diff(F.col("o_orderdate").cast("date"), F.lit(dt.date(1899, 12, 30))).cast("string")
    filled = F.array(
        F.when(key % 2 == 0, serial).otherwise(F.col("o_orderdate").cast("date").cast("string")),
        F.concat(F.lit(" "), "o_orderpriority", F.lit(IDEOGRAPHIC_SPACE)),
        F.col("o_custkey").cast("string"),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.col("o_orderstatus")),
        F.lit("默认"),
        (key % 9).cast("string"),
        price.cast("string"),
        (price * 2).cast("decimal(16,2)").cast("string"),
        F.concat(F.lit("S"), key),
        F.when(key % 4 == 0, F.col("o_orderstatus")).otherwise(F.lit("")),
    )
    blank = F.array(F.lit(""), F.lit(" "), F.lit(IDEOGRAPHIC_SPACE))
    data = t.spread("orders").select(
        shop_book(F.col("o_custkey") % 25).alias("workbook_identifier"),
        *sheet,
        (key + 2).cast("int").alias("row_number"),
        indexed_map(F.when(key % 11 == 0, blank).otherwise(filled)).alias("cells"),
    )
    return header.unionByName(data)


def family_rows(t: Tables) -> DataFrame:
    """All seven sheets of every shop's workbook: a header row per sheet, orders dealt to the sheets as data rows.

    Every fifth shop uses the last accepted header of each field, every third has no header for the last field.
    """
    shop, key = F.col("n_nationkey"), F.col("o_orderkey")
    parts = []
    for i, contract in enumerate(DATASETS.values()):
        sheet = [F.lit(f"①{contract.sheet_token}").alias("sheet_name"), F.lit(i + 1).alias("sheet_index")]
        names = [F.when(shop % 5 == 0, f.headers[-1]).otherwise(f.headers[0]) for f in contract.fields]
        names[-1] = F.when(shop % 3 != 0, names[-1]).otherwise("")
        header = indexed_map(F.array(*names, F.lit("备注")))
        parts.append(t.nation.select(shop_book(shop).alias("workbook_identifier"), *sheet, F.lit(1).alias("row_number"), header.alias("cells")))
        values = []
        for j, name in enumerate(contract.field_names):
            text = F.when((key + j) % 5 == 0, " ").otherwise(F.concat(F.lit(f" v{j}-"), key))
            values.append(F.col("o_orderdate").cast("date").cast("string") if name == "sales_date" else text)
        note = F.when(key % 4 == 0, F.col("o_orderstatus")).otherwise("")
        cells = indexed_map(F.when(key % 11 == 0, F.array(F.lit(""), F.lit(IDEOGRAPHIC_SPACE))).otherwise(F.array(*values, note)))
        book = shop_book(F.col("o_custkey") % 25).alias("workbook_identifier")
        data = t.spread("orders").filter(key % len(DATASETS) == i)
        parts.append(data.select(book, *sheet, (key + 2).cast("int").alias("row_number"), cells.alias("cells")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def shop_files(t: Tables) -> DataFrame:
    book = shop_book(F.col("n_nationkey"))
    return t.nation.select(
        book.alias("workbook_identifier"),
        F.concat(F.lit("/landing/"), book, F.lit(".xlsx")).alias("workbook_path"),
        F.concat(book, F.lit(".xlsx")).alias("workbook_file_name"),
        F.sha2(book, 256).alias("workbook_file_hash"),
        F.concat(F.lit("pdd_"), "n_nationkey").alias("shop_code"),
    )


def order_cells(t: Tables) -> DataFrame:
    """Orders as cells in columns A, B, Z and AA; some cells absent, B points to a shared string."""
    key = F.col("o_orderkey")
    row = (key + 2).cast("int")

    def cell(column: str, kind: str, value: Column) -> Column:
        return F.struct(
            F.concat(F.lit(column), row).alias("cell_ref"), F.lit(kind).alias("cell_type"), value.alias("value")
        )

    cells = F.array_compact(
        F.array(
            cell("A", "n", F.col("o_orderdate").cast("date").cast("string")),
            F.when(key % 3 != 0, cell("B", "s", F.col("o_custkey").cast("string"))),
            cell("Z", "inlineStr", F.col("o_orderpriority")),
            F.when(key % 7 != 0, cell("aa", "n", F.when(key % 5 != 0, F.col("o_totalprice").cast("decimal(14,2)").cast("string")))),
        )
    )
    return t.orders.select(
        F.concat(F.lit("pdd_"), F.col("o_custkey") % 25).alias("workbook_identifier"),
        F.lit("数据").alias("sheet_name"),
        F.lit(1).alias("sheet_index"),
        row.alias("row_number"),
        F.inline(cells),
    )


def customer_strings(t: Tables) -> DataFrame:
    return t.customer.select(
        F.concat(F.lit("pdd_"), F.col("c_custkey") % 25).alias("workbook_identifier"),
        F.col("c_custkey").cast("int").alias("string_index"),
        F.col("c_name").alias("text"),
    )


def rule_tables(t: Tables) -> dict[str, DataFrame]:
    """The layers with broken rules of every kind, from expressions that SQL and Spark share."""
    layers = {
        "platforms": (t.region, RULE_COLUMNS["platforms"]),
        "shops": (t.nation, RULE_COLUMNS["shops"]),
        "source_file_types": (t.part, RULE_COLUMNS["source_file_types"]),
        "import_files": (t.customer, RULE_COLUMNS["import_files"]),
        "import_file_sheets": (t.orders, RULE_COLUMNS["import_file_sheets"]),
        "raw_import_rows": (t.lineitem, RULE_COLUMNS["raw_import_rows"]),
        "stg_shop_day": (t.orders, RULE_COLUMNS["stg_shop_day"]),
        "stg_sku_day": (t.lineitem, RULE_COLUMNS["stg_sku_day"]),
        "fact_shop_day": (t.orders, RULE_COLUMNS["fact_shop_day"]),
        "fact_sku_day": (t.lineitem, RULE_COLUMNS["fact_sku_day"]),
        "spu_snapshot": (t.part, RULE_COLUMNS["spu_snapshot"]),
    }
    return {name: df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]) for name, (df, columns) in layers.items()}


#: Columns of the layers as expressions on the test tables.
RULE_COLUMNS = {
    "platforms": {"platform_id": "r_regionkey", "platform_code": "r_name", "platform_name": "CASE WHEN r_regionkey <> 3 THEN r_name END"},
    "shops": {
        "shop_id": "n_nationkey",
        "platform_id": "CASE WHEN n_nationkey % 10 = 9 THEN 99 ELSE n_regionkey END",
        "shop_code": "n_nationkey % 4",
        "is_active": "CASE WHEN n_nationkey % 8 <> 1 THEN true END",
        "created_at": "n_name",
    },
    "source_file_types": {
        "source_file_type_id": "p_partkey",
        "platform_id": "p_size % 7",
        "file_type_code": "p_brand",
        "file_type_name": "p_name",
        "grain_code": "p_type",
        "version": "p_size",
        "is_active": "p_size > 0",
    },
    "import_files": {
        "import_file_id": "c_custkey",
        "source_file_type_id": "c_custkey * 3",
        "platform_id": "c_nationkey % 6",
        "shop_id": "CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey + CASE WHEN c_custkey % 9 = 0 THEN 100 ELSE 0 END END",
        "file_path": "c_name",
        "file_name": "c_mktsegment",
        "imported_at": "c_acctbal",
    },
    "import_file_sheets": {
        "import_file_id": "o_custkey * 2",
        "sheet_name": "o_orderpriority",
        "sheet_index": "o_orderkey % 8",
        "is_relevant": "o_orderstatus = 'F'",
    },
    "raw_import_rows": {
        "import_file_id": "l_suppkey * 7",
        "row_number": "l_orderkey",
        "sheet_name": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END",
        "raw_payload": "CASE WHEN l_linenumber < 7 THEN l_linestatus END",
    },
    "stg_shop_day": {
        "import_file_id": "o_custkey",
        "source_row_number": "o_orderkey % 3000",
        "shop_id": "o_custkey % 26",
        "sales_date": "CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END",
    },
    "stg_sku_day": {
        "import_file_id": "l_suppkey * 7",
        "source_row_number": "l_orderkey + CASE WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END",
        "shop_id": "l_suppkey % 26",
        "sales_date": "CASE WHEN l_linenumber <> 3 THEN l_shipdate END",
    },
    "fact_shop_day": {
        "shop_id": "o_custkey % 25",
        "sales_date": "CAST(o_orderdate AS DATE)",
        "import_file_id": "o_custkey + 3",
        "source_row_number": "o_orderkey",
    },
    "fact_sku_day": {
        "shop_id": "l_suppkey % 25",
        "sales_date": "CAST(l_shipdate AS DATE)",
        "product_id": "l_partkey",
        "sku_id": "l_suppkey",
        "merchant_sku_code": "CASE WHEN l_linenumber <> 2 THEN l_returnflag END",
        "product_specification": "l_linestatus",
        "import_file_id": "l_suppkey * 90",
        "source_row_count": "l_linenumber",
    },
    "spu_snapshot": {
        "shop_code": "p_size % 3",
        "sales_date": "p_size % 2",
        "spu_name": "p_brand",
        "campaign_name": "p_type",
        "listing_name": "CASE WHEN p_size <> 7 THEN p_size END",
        "source_row_count": "p_size",
    },
}


def recent(t: Tables) -> tuple[dt.date, dt.date]:
    """Latest date and the day before its 30-day window."""
    latest = latest_sale(t)
    return latest, window_start(latest)
