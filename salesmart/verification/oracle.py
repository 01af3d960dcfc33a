"""Reference SQL for every registered query, over the same tables.

Written from the raw tables in whole numbers (cents, counts), independent of
the library: ratios are rounded with integer arithmetic.
"""

from __future__ import annotations

import json
import re

from ..contracts import CANONICAL_COLUMNS, DATASETS, SOURCE_TYPE_SEEDS, Contract
from ..operators.rules import REFERENCES, REQUIRED, UNIQUE, Reference, Required, Unique
from .bindings import RULE_COLUMNS

# Fixed values shared with the reports.
TRIAL_NOTE = "试运行预览：基于标准化 SPU源数据 生成，供 Metabase 预览使用，暂不视为正式事实层。"
DAILY_NOTE = "基于当前店铺日事实层和店铺日分层指标重建，暂未补齐推广明细和部分口碑展示字段。"
MONTHLY_NOTE = "按当前店铺日事实层月度汇总生成，店铺关注用户数和推广拆分字段暂未完整建模。"
SPU_NOTE = "基于标准化 SPU源数据 生成的临时监控视图，未复刻原始图片和矩阵排版，可作为下一步 SPU 决策层的过渡输出。"


def half_up(a: str, b: str, places: int, scale: int = 0) -> str:
    """``a / b`` half away from zero; ``a`` is a count of ``10**-scale`` units."""
    n = f"({a}) * {10 ** (places - scale)}"
    return f"CAST((2 * {n} + ({b})) // (2 * NULLIF({b}, 0)) AS DOUBLE) / {10**places}"


def half_even_units(a: str, b: str) -> str:
    """Whole-number quotient, ties to even; 0 when ``b`` is 0."""
    q, r = f"(({a}) // ({b}))", f"(({a}) % ({b}))"
    return (
        f"CASE WHEN ({b}) = 0 THEN 0 WHEN 2 * {r} > ({b}) OR (2 * {r} = ({b}) AND {q} % 2 = 1) "
        f"THEN {q} + 1 ELSE {q} END"
    )


def cents(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / 100"


def fixed(units: str, places: int) -> str:
    u = f"CAST({units} AS BIGINT)"
    return f"CAST({u} // {10**places} AS VARCHAR) || '.' || lpad(CAST({u} % {10**places} AS VARCHAR), {places}, '0')"


def big(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


FAMILY_VALUES = ", ".join(f"({i}, '{code}', '{c.grain}', '{c.sheet_token}')" for i, (code, c) in enumerate(DATASETS.items()))


def _mapping(contract: Contract, last_header: bool, short: bool) -> dict[str, str]:
    fields = contract.fields[:-1] if short else contract.fields
    return {f.name: f.headers[-1 if last_header else 0] for f in fields}


def _by_shop(text) -> str:
    """A text for each kind of shop: every fifth uses last headers, every third lacks the last field."""
    n = "shop_number"
    cases = {(True, True): f"{n} % 15 = 0", (True, False): f"{n} % 5 = 0", (False, True): f"{n} % 3 = 0"}
    whens = " ".join(f"WHEN {test} THEN '{text(*kind)}'" for kind, test in cases.items())
    return f"CASE {whens} ELSE '{text(False, False)}' END"


def _family_dataset(i: int, code: str, contract: Contract) -> str:
    values = []
    for name in CANONICAL_COLUMNS:
        if name not in contract.field_names:
            values.append("'~'")
            continue
        j = contract.field_names.index(name)
        if name == "sales_date":
            value = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
        else:
            value = f"CASE WHEN (o_orderkey + {j}) % 5 = 0 THEN '~' ELSE 'v{j}-' || o_orderkey END"
        values.append(f"CASE WHEN shop_number % 3 = 0 THEN '~' ELSE {value} END" if j == len(contract.fields) - 1 else value)
    variant = _by_shop(lambda last, short: json.dumps(_mapping(contract, last, short), ensure_ascii=False, sort_keys=True))
    return f"""
        SELECT '{code}' AS dataset_code, '{contract.grain}' AS grain_code, 'pdd_' || shop_number || '_workbook_2026' AS workbook_identifier,
            'pdd_' || shop_number AS shop_code, '①{contract.sheet_token}' AS sheet_name, CAST({i + 1} AS BIGINT) AS sheet_index,
            o_orderkey + 2 AS source_row_number, {variant} AS source_header_variant,
            CASE WHEN o_orderkey % 4 = 0 THEN '{{"备注": "' || o_orderstatus || '"}}' END AS source_extra_payload_json,
            md5({" || '|' || ".join(values)}) AS digest
        FROM (SELECT *, o_custkey % 25 AS shop_number FROM orders WHERE o_orderkey % 7 = {i} AND o_orderkey % 11 <> 0)"""


FAMILY_SQL = " UNION ALL ".join(_family_dataset(i, code, c) for i, (code, c) in enumerate(DATASETS.items()))


def _schema_rows(i: int, code: str, contract: Contract) -> str:
    def headers(last: bool, short: bool) -> str:
        return ",".join([*_mapping(contract, last, short).values(), "备注"])

    final = contract.fields[-1]
    missing = final.headers[0] if len(final.headers) == 1 else ""
    return f"""
        SELECT '{code}' AS dataset_code, '{contract.grain}' AS grain_code, 'pdd_' || shop_number || '_workbook_2026' AS workbook_identifier,
            '①{contract.sheet_token}' AS sheet_name,
            (SELECT count(*) FROM orders WHERE o_orderkey % 7 = {i} AND o_orderkey % 11 <> 0 AND o_custkey % 25 = shop_number) AS row_count,
            CAST({len(contract.fields)} - CASE WHEN shop_number % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS matched_count,
            {_by_shop(headers)} AS headers, CASE WHEN shop_number % 3 = 0 THEN '{missing}' ELSE '' END AS missing_headers,
            '备注' AS unexpected_headers
        FROM (SELECT n_nationkey AS shop_number FROM nation)"""


SCHEMA_MANIFEST_SQL = " UNION ALL ".join(_schema_rows(i, code, c) for i, (code, c) in enumerate(DATASETS.items()))

RULE_SOURCES = {
    "platforms": "region",
    "shops": "nation",
    "source_file_types": "part",
    "import_files": "customer",
    "import_file_sheets": "orders",
    "raw_import_rows": "lineitem",
    "stg_shop_day": "orders",
    "stg_sku_day": "lineitem",
    "fact_shop_day": "orders",
    "fact_sku_day": "lineitem",
    "spu_snapshot": "part",
}


def _rule_source(table: str) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in RULE_COLUMNS[table].items())
    return f"(SELECT {columns} FROM {RULE_SOURCES[table]})"


def _rule_row(kind: str, table: str, columns: str, parent: str | None, keys: str, rows: str, source: str) -> str:
    shown = f"'{parent}'" if parent else "NULL"
    return (
        f"SELECT '{kind}' AS kind, '{table}' AS \"table\", '{columns}' AS columns, {shown} AS parent, "
        f"CAST({keys} AS BIGINT) AS violating_keys, CAST(coalesce({rows}, 0) AS BIGINT) AS violating_rows FROM {source}"
    )


def _unique_sql(r: Unique) -> str:
    keys = ", ".join(f"coalesce({c}, '')" if c in r.blank else c for c in r.columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in r.columns if c not in r.blank)
    source = f"(SELECT count(*) AS n FROM {_rule_source(r.table)} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
    return _rule_row("unique", r.table, ", ".join(r.columns), None, "count(*)", "sum(n)", source)


def _reference_sql(r: Reference) -> str:
    present = " AND ".join(f"c.{c} IS NOT NULL" for c in r.columns)
    same = " AND ".join(f"p.{a} = c.{b}" for a, b in zip(r.parent_columns, r.columns, strict=True))
    lost = f"(SELECT * FROM {_rule_source(r.table)} c WHERE {present} AND NOT EXISTS (SELECT 1 FROM {_rule_source(r.parent)} p WHERE {same}))"
    keys = f"count(DISTINCT ({', '.join(r.columns)}))"
    return _rule_row("reference", r.table, ", ".join(r.columns), r.parent, keys, "count(*)", lost)


def _required_sql(r: Required) -> str:
    return _rule_row("required", r.table, r.column, None, "0", f"count(*) FILTER (WHERE {r.column} IS NULL)", _rule_source(r.table))


RULES_SQL = " UNION ALL ".join([*map(_unique_sql, UNIQUE), *map(_reference_sql, REFERENCES), *map(_required_sql, REQUIRED)])

IDENTITY = "product_id, sku_id, merchant_sku_code, product_specification"

CTES = {
    "line": """
        SELECT s.s_nationkey AS shop_id, CAST(l.l_shipdate AS DATE) AS sales_date, l.l_orderkey, l.l_linenumber,
            l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus, CAST(l.l_quantity AS BIGINT) AS units,
            CAST(round(l.l_extendedprice * 100) AS BIGINT) AS gross, CAST(round(l.l_discount * 100) AS BIGINT) AS off,
            o.o_custkey, p.p_name, p.p_brand, p.p_type, p.p_size
        FROM lineitem l
        JOIN supplier s ON s.s_suppkey = l.l_suppkey
        JOIN part p ON p.p_partkey = l.l_partkey
        JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "shop": """
        SELECT n_nationkey AS shop_id, n_regionkey AS platform_id, 'pdd_' || n_nationkey AS shop_code,
            CASE WHEN n_nationkey % 7 = 0 THEN 'pdd_' || n_nationkey ELSE n_name END AS shop_name
        FROM nation""",
    "shop_sum": """
        SELECT shop_id, sales_date, day(sales_date) AS d, count(DISTINCT o_custkey) AS buyers,
            count(DISTINCT l_orderkey) AS orders, CAST(sum(gross) AS BIGINT) AS gross,
            CAST(sum(gross) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS refund
        FROM line GROUP BY ALL""",
    "shop_day": f"""
        SELECT *, {half_up("buyers", "visitors", 4)} AS derived_rate, {half_up("gross", "buyers", 2, 2)} AS derived_aov,
            {half_up("gross", "visitors", 2, 2)} AS derived_uv, buyers % 4 AS favourites,
            date_diff('day', DATE '1994-12-31', sales_date) + 1 AS row_no
        FROM (SELECT *, CASE d WHEN 13 THEN 0 WHEN 17 THEN NULL ELSE buyers * (1 + (shop_id + d) % 9) END AS visitors
            FROM shop_sum)""",
    "shop_source": """
        SELECT *, CASE WHEN d = 11 THEN 4.95::DOUBLE ELSE derived_rate END AS source_rate, derived_aov AS source_aov,
            CASE WHEN d = 5 THEN 0.09::DOUBLE ELSE derived_uv END AS source_uv
        FROM shop_day""",
    "fact": """
        SELECT * REPLACE (gross * (second + 1) AS gross), shop_id + 1 + 1000 * second AS import_file_id
        FROM (SELECT *, CASE WHEN shop_id % 2 = 0 AND sales_date >= DATE '2000-01-01' THEN 1 ELSE 0 END AS second
            FROM shop_source)""",
    "sku_line": """
        SELECT shop_id, sales_date, l_orderkey, l_linenumber,
            CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE p_name END AS product_name,
            CAST(l_partkey AS VARCHAR) AS product_id, l_partkey || '-' || l_suppkey AS sku_id,
            CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE p_brand END AS merchant_sku_code,
            CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE p_type || '/' || p_size END AS product_specification,
            units, gross, (2 * gross * (100 - off) + 100) // 200 AS net
        FROM line JOIN (VALUES (1), (2)) AS r(repeat) ON repeat = 1 OR l_linenumber = 1""",
    "sku_stg": """
        SELECT shop_id, sales_date, product_name, product_id, sku_id, merchant_sku_code, product_specification,
            units, gross, net, shop_id + 1 AS import_file_id FROM sku_line
        UNION ALL
        SELECT shop_id, sales_date, product_name || ' v2', product_id, sku_id, merchant_sku_code,
            product_specification, units + 1, gross, net, shop_id + 1001 FROM sku_line
        WHERE sales_date >= DATE '2001-01-01'""",
    "sku_total": """
        SELECT import_file_id, shop_id, sales_date, product_id, sku_id, coalesce(merchant_sku_code, '') AS merchant_sku_code,
            coalesce(product_specification, '') AS product_specification, CAST(sum(units) AS BIGINT) AS units,
            CAST(sum(gross) AS BIGINT) AS gross, CAST(sum(net) AS BIGINT) AS net, count(*) AS source_rows,
            max(product_name) AS product_name
        FROM sku_stg GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "sku_fact": """
        SELECT * FROM sku_total WHERE (import_file_id > 1000) = (sales_date >= DATE '2001-01-01')""",
    "sku_view": """
        SELECT shop_code, shop_name, sales_date, product_name, product_id, sku_id,
            nullif(merchant_sku_code, '') AS merchant_sku_code, nullif(product_specification, '') AS product_specification,
            units, gross, net, source_rows
        FROM sku_fact JOIN shop USING (shop_id)""",
    "sku_recent": """
        SELECT * FROM sku_view WHERE sales_date > (SELECT max(sales_date) FROM sku_view) - INTERVAL 30 DAY""",
    "spu_row": """
        SELECT 'pdd_' || shop_id AS shop_code, date_trunc('year', sales_date)::DATE AS sales_date, p_type AS spu,
            CASE WHEN l_partkey % 5 = 0 THEN '' ELSE p_brand END AS campaign, l_linestatus AS listing,
            units * 3 AS visitors, units * 70 + 5 AS view_tenths, units,
            CASE WHEN l_linenumber = 2 THEN 0 ELSE 1 END AS buyers, CASE WHEN l_linenumber = 4 THEN 0 ELSE 1 END AS orders,
            CASE WHEN l_linenumber = 7 THEN 0 ELSE gross END AS gross,
            CASE WHEN l_linenumber = 3 THEN 0 ELSE l_linenumber END AS favourites
        FROM line WHERE NOT (l_linenumber = 5 AND l_partkey % 10 = 0)""",
    "spu": """
        SELECT shop_code, sales_date, spu, campaign, listing, CAST(sum(visitors) AS BIGINT) AS visitors,
            CAST(sum(view_tenths) AS BIGINT) AS view_tenths, CAST(sum(units) AS BIGINT) AS units,
            CAST(sum(buyers) AS BIGINT) AS buyers, CAST(sum(orders) AS BIGINT) AS orders,
            CAST(sum(gross) AS BIGINT) AS gross, CAST(sum(favourites) AS BIGINT) AS favourites, count(*) AS source_rows
        FROM spu_row WHERE (shop_code, sales_date) IN (SELECT (shop_code, max(sales_date)) FROM spu_row GROUP BY shop_code)
        GROUP BY 1, 2, 3, 4, 5""",
    "wb": "SELECT *, 'wb_' || o_orderkey AS workbook_identifier, o_orderkey AS k FROM orders",
    "sheet": """
        SELECT workbook_identifier, CAST(i AS BIGINT) AS sheet_index,
            CASE i WHEN 2 THEN '①日报数据源' || (k % 7) WHEN 3 THEN ' SKU源数据 ' WHEN 4 THEN 'WpsReserved_CellImgList'
                WHEN 5 THEN 'Sheet' || k WHEN 6 THEN 'Sheet' || k || 'x' ELSE o_orderpriority || '月报' || i END AS sheet_name,
            CASE i WHEN 2 THEN 'raw-source' WHEN 3 THEN 'raw-source' WHEN 4 THEN 'ignore' WHEN 5 THEN 'ignore'
                ELSE 'mixed/presentation' END AS sheet_group
        FROM wb, generate_series(1, 7) AS g(i) WHERE i <= 3 + k % 5""",
    "sheet_row": """
        SELECT 'wb_' || l_orderkey AS workbook_identifier, CAST(l_linenumber AS BIGINT) AS sheet_index,
            CASE WHEN l_suppkey % 9 <> 0 THEN 1 + l_partkey % 3 END AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "wb_file": """
        SELECT workbook_identifier AS w FROM wb WHERE k % 7 <> 0 UNION ALL SELECT 'wb_c' || c_custkey FROM customer""",
    "family": "SELECT * FROM (VALUES " + FAMILY_VALUES + ") AS f(i, code, grain, token)",
    "sku_sheet": """
        SELECT *, 'pdd_' || (o_custkey % 25) || '_workbook_2026' AS book, o_orderkey + 2 AS row_no,
            CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_text, CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR) AS price,
            CAST(CAST(o_totalprice AS DECIMAL(14, 2)) * 2 AS DECIMAL(16, 2))::VARCHAR AS double_price
        FROM orders WHERE o_orderkey % 11 <> 0""",
    "book": """
        SELECT n_nationkey, 'pdd_' || n_nationkey || '_workbook_2026' AS book FROM nation""",
}


def sql(body: str) -> str:
    """Prefix a query with the named relations it uses, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


SHOP_TOTALS = """sum(visitors) AS visitors, sum(3 * visitors) AS shop_views, sum(2 * visitors) AS product_visitors,
    sum(5 * visitors) AS product_views, sum(buyers) AS buyers, sum(orders) AS orders, sum(gross) AS gross,
    sum(refund) AS refund, sum(favourites) AS favourites"""
SHOP_COLUMNS = f"""CAST(visitors AS BIGINT) AS "店铺访客数", CAST(shop_views AS BIGINT) AS "店铺浏览量",
    CAST(product_visitors AS BIGINT) AS "商品访客数", CAST(product_views AS BIGINT) AS "商品浏览数",
    CAST(buyers AS BIGINT) AS "买家数", CAST(orders AS BIGINT) AS "订单数", {cents("gross")} AS "成交金额",
    {cents("refund")} AS "退款金额", CAST(favourites AS BIGINT) AS "商品收藏用户数" """
DAY_COLUMNS = "3 * visitors AS shop_views, 2 * visitors AS product_visitors, 5 * visitors AS product_views"


def shop_ratios(rate: str, aov: str, uv: str) -> str:
    return (
        f'{half_up("buyers", "visitors", 4)} AS "{rate}", {half_up("gross", "buyers", 2, 2)} AS "{aov}", '
        f'{half_up("gross", "visitors", 2, 2)} AS "{uv}"'
    )


RATIOS = shop_ratios("转化率", "客单价", "UV价值")
DERIVED = shop_ratios("推导转化率", "推导客单价", "推导UV价值")

STG_SHOP_COLUMNS = f"""CAST(row_no AS BIGINT) AS source_row_number, CAST(sales_date AS VARCHAR) AS sales_date,
    CAST(visitors AS BIGINT) AS shop_visitor_count, CAST(3 * visitors AS BIGINT) AS shop_pageview_count,
    CAST(2 * visitors AS BIGINT) AS product_visitor_count, CAST(5 * visitors AS BIGINT) AS product_pageview_count,
    CAST(buyers AS BIGINT) AS buyer_count, CAST(orders AS BIGINT) AS order_count, {cents("gross")} AS gross_sales_amount,
    source_rate AS conversion_rate, source_aov AS avg_order_value, source_uv AS uv_value,
    CAST(favourites AS BIGINT) AS product_favorite_user_count, {cents("refund")} AS refund_amount"""

SPU_NUMBERS = f"""CAST(visitors AS DOUBLE) AS "商品访客量", CAST(view_tenths AS DOUBLE) / 10 AS "商品浏览量",
    CAST(units AS DOUBLE) AS "销量", CAST(buyers AS DOUBLE) AS "买家数", CAST(orders AS DOUBLE) AS "订单数",
    {cents("gross")} AS "销售额", CAST(favourites AS DOUBLE) AS "商品收藏用户数",
    coalesce({half_up("buyers", "visitors", 6)}, 0) AS "转化率", coalesce({half_up("gross", "buyers", 2, 2)}, 0) AS "客单价",
    source_rows AS "来源行数" """
SPU_LABELS = f"""'PDD' AS "平台", '试运行' AS "状态", shop_code AS "店铺编码", shop_code AS "店铺",
    CAST(sales_date AS VARCHAR) AS "日期", spu AS "SPU", nullif(campaign, '') AS "计划名", nullif(listing, '') AS "链接名称",
    {SPU_NUMBERS}, '{TRIAL_NOTE}' AS "说明" """


def header_json(pairs: list[tuple[str, str]]) -> str:
    """JSON object over (key, SQL text of the header)."""
    return "'{' || " + " || ', ' || ".join(f"""'"{k}": "' || {v} || '"'""" for k, v in sorted(pairs)) + " || '}'"


FAMILY = "CASE WHEN k % 3 = 1 THEN '支付' ELSE '成交' END"
SHOP_HEADER_JSON = header_json(
    [
        ("sales_date", "'日期'"),
        ("shop_visitor_count", "'店铺访客数'"),
        ("shop_pageview_count", "'店铺浏览量'"),
        ("product_visitor_count", "'商品访客数'"),
        ("product_pageview_count", "'商品浏览数'"),
        ("buyer_count", f"{FAMILY} || '买家数'"),
        ("order_count", f"{FAMILY} || '订单数'"),
        ("gross_sales_amount", f"{FAMILY} || '金额'"),
        ("conversion_rate", f"{FAMILY} || '转化率'"),
        ("avg_order_value", "'客单价'"),
        ("uv_value", "'UV价值'"),
        ("product_favorite_user_count", "'商品收藏用户数'"),
        ("refund_amount", "'退款金额'"),
    ]
)
NET_HEADER = "CASE WHEN n_nationkey % 2 = 0 THEN '商家实收金额（元）' ELSE '商家实收金额(元)' END"
SKU_HEADER_JSON = header_json(
    [
        ("sales_date", "'日期'"),
        ("product_name", "'商品'"),
        ("product_id", "'商品id'"),
        ("merchant_sku_code", "'商家编码-SKU维度'"),
        ("product_specification", "'商品规格'"),
        ("quantity_units", "'商品数量(件)'"),
        ("gross_product_amount", "'商品总价(元)'"),
        ("merchant_net_amount", NET_HEADER),
        ("sku_id", "'SKU-ID'"),
    ]
)

BLANKS = " || ".join(
    f"chr({code})"
    for code in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)

REQUIRED = (
    "sales_date shop_visitor_count shop_pageview_count product_visitor_count product_pageview_count buyer_count "
    "order_count gross_sales_amount conversion_rate avg_order_value uv_value product_favorite_user_count refund_amount"
).split()

TOKENS = {
    1: ("SPU源数据", "spu_source"),
    2: ("SKU源数据", "sku_source"),
    3: ("日报数据源", "shop_daily_source"),
    4: ("推广数据源（总）", "promotion_total_source"),
    5: ("推广数据源（单）", "promotion_campaign_source"),
    6: ("店铺商品信息", "shop_product_source"),
    7: ("商品评分数据源", "product_rating_source"),
}
TOKEN_ROWS = ", ".join(f"({i}, '{token}', '{code}')" for i, (token, code) in TOKENS.items())


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SEED_VALUES = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in SOURCE_TYPE_SEEDS)

SKU_MONEY = f"""CAST(units AS DOUBLE) AS gross_quantity, {cents("gross")} AS gross_product_amount,
    {cents("net")} AS merchant_net_amount"""
SKU_LABELS = f"""'PDD' AS "平台", shop_code AS "店铺编码", shop_name AS "店铺", product_name AS "商品名称"
"""

BODIES = {
    "view_shop_daily": f"""
        SELECT 'PDD' AS "平台", shop_code AS "店铺编码", shop_name AS "店铺", CAST(sales_date AS VARCHAR) AS "日期",
            {SHOP_COLUMNS}, {RATIOS}
        FROM (SELECT *, {DAY_COLUMNS} FROM fact JOIN shop USING (shop_id))""",
    "view_shop_monthly": f"""
        SELECT 'PDD' AS "平台", shop_code AS "店铺编码", shop_name AS "店铺", strftime(m, '%Y-%m') AS "月份",
            days AS "覆盖天数", {SHOP_COLUMNS}, {RATIOS}
        FROM (SELECT shop_code, shop_name, date_trunc('month', sales_date) AS m, count(*) AS days, {SHOP_TOTALS}
            FROM fact JOIN shop USING (shop_id) GROUP BY 1, 2, 3)""",
    "view_top_summary_daily": f"""
        SELECT 'PDD' AS "平台", CAST(sales_date AS VARCHAR) AS "日期", shops AS "覆盖店铺数", {SHOP_COLUMNS}, {RATIOS}
        FROM (SELECT sales_date, count(DISTINCT shop_code) AS shops, {SHOP_TOTALS}
            FROM fact JOIN shop USING (shop_id) GROUP BY 1)""",
    "view_shop_rank_30d": f"""
        SELECT '近30天' AS "统计窗口", 'PDD' AS "平台", shop_code AS "店铺编码", shop_name AS "店铺", days AS "覆盖天数",
            CAST(visitors AS BIGINT) AS "店铺访客数", CAST(buyers AS BIGINT) AS "买家数", CAST(orders AS BIGINT) AS "订单数",
            {cents("gross")} AS "成交金额", {cents("refund")} AS "退款金额", {RATIOS},
            dense_rank() OVER (ORDER BY gross DESC NULLS FIRST) AS "成交金额排名",
            dense_rank() OVER (ORDER BY buyers DESC NULLS FIRST) AS "买家数排名"
        FROM (SELECT shop_code, shop_name, count(*) AS days, {SHOP_TOTALS} FROM fact JOIN shop USING (shop_id)
            WHERE sales_date > (SELECT max(sales_date) FROM fact) - INTERVAL 30 DAY GROUP BY 1, 2)""",
    "review_daily": f"""
        SELECT '日报' AS "报表类型", '经营复盘表' AS "报表定位", shop_code AS "店铺", CAST(sales_date AS VARCHAR) AS "日期",
            {SHOP_COLUMNS}, {DERIVED}, source_rate AS "源表转化率", source_aov AS "源表客单价", source_uv AS "源表UV价值",
            CAST(import_file_id AS BIGINT) AS "导入批次", row_no AS "来源行号", '{DAILY_NOTE}' AS "说明"
        FROM (SELECT *, {DAY_COLUMNS} FROM fact JOIN shop USING (shop_id))""",
    "review_monthly": f"""
        SELECT '月报' AS "报表类型", '月度管理汇总' AS "报表定位", shop_code AS "店铺", strftime(m, '%Y-%m') AS "月份",
            days AS "覆盖天数", {SHOP_COLUMNS}, {DERIVED}, '{MONTHLY_NOTE}' AS "说明"
        FROM (SELECT shop_code, date_trunc('month', sales_date) AS m, count(*) AS days, {SHOP_TOTALS}
            FROM fact JOIN shop USING (shop_id) GROUP BY 1, 2)""",
    "current_version_join": f"""
        SELECT CAST(shop_id AS BIGINT) AS shop_id, CAST(sales_date AS VARCHAR) AS sales_date,
            CAST(import_file_id AS BIGINT) AS import_file_id, row_no AS source_row_number,
            {cents("gross")} AS gross_sales_amount, CAST(visitors AS BIGINT) AS shop_visitor_count,
            source_rate AS conversion_rate
        FROM fact""",
    "fact_sku_day": f"""
        SELECT {big("import_file_id", "shop_id")}, CAST(sales_date AS VARCHAR) AS sales_date, {IDENTITY}, {SKU_MONEY},
            source_rows AS source_row_count
        FROM sku_total""",
    "sku_display_name": f"""
        SELECT {big("import_file_id", "shop_id")}, CAST(sales_date AS VARCHAR) AS sales_date, {IDENTITY}, product_name
        FROM sku_total""",
    "display_name_join": f"""
        SELECT {big("import_file_id", "shop_id")}, CAST(sales_date AS VARCHAR) AS sales_date, {IDENTITY}, product_name,
            source_rows AS source_row_count FROM sku_total""",
    "view_sku_daily": f"""
        SELECT {SKU_LABELS}, CAST(sales_date AS VARCHAR) AS "日期", product_id AS "商品ID", sku_id AS "SKU-ID",
            merchant_sku_code AS "商家SKU编码", product_specification AS "商品规格", CAST(units AS DOUBLE) AS "销量",
            {cents("gross")} AS "商品总价", {cents("net")} AS "商家实收金额", source_rows AS "来源行数"
        FROM sku_view""",
    "view_sku_rank_30d": f"""
        SELECT '近30天' AS "统计窗口", {SKU_LABELS}, product_id AS "商品ID", sku_id AS "SKU-ID",
            merchant_sku_code AS "商家SKU编码", product_specification AS "商品规格", CAST(sum(units) AS DOUBLE) AS "销量",
            {cents("sum(gross)")} AS "商品总价", {cents("sum(net)")} AS "商家实收金额",
            CAST(sum(source_rows) AS BIGINT) AS "来源行数",
            dense_rank() OVER (ORDER BY sum(net) DESC NULLS FIRST) AS "商家实收金额排名",
            dense_rank() OVER (ORDER BY sum(units) DESC NULLS FIRST) AS "销量排名"
        FROM sku_recent
        GROUP BY shop_code, shop_name, product_name, product_id, sku_id, merchant_sku_code, product_specification""",
    "view_product_cards_30d": f"""
        SELECT '近30天' AS "统计窗口", 'PDD' AS "平台", w.shop_code AS "店铺编码", w.shop_name AS "店铺", r.rank AS "卡片排序",
            w.product_name AS "商品名称", w.product_specification AS "商品规格", CAST(w.sales_date AS VARCHAR) AS "日期",
            CAST(sum(w.units) AS DOUBLE) AS "销量", {cents("sum(w.gross)")} AS "商品总价", {cents("sum(w.net)")} AS "商家实收金额"
        FROM sku_recent w
        JOIN (SELECT shop_code, product_name, coalesce(product_specification, '') AS spec,
                dense_rank() OVER (PARTITION BY shop_code ORDER BY sum(net) DESC NULLS FIRST, product_name NULLS LAST,
                    coalesce(product_specification, '')) AS rank
            FROM sku_recent GROUP BY shop_code, shop_name, product_name, coalesce(product_specification, '')) r
          ON r.shop_code = w.shop_code AND r.product_name = w.product_name
         AND r.spec = coalesce(w.product_specification, '')
        WHERE r.rank <= 6
        GROUP BY w.shop_code, w.shop_name, r.rank, w.product_name, w.product_specification, w.sales_date""",
    "spu_snapshot": f"""
        SELECT shop_code, CAST(sales_date AS VARCHAR) AS sales_date, spu AS spu_name, campaign AS campaign_name,
            listing AS listing_name, CAST(visitors AS DOUBLE) AS product_visitor_count,
            CAST(view_tenths AS DOUBLE) / 10 AS product_pageview_count, CAST(units AS DOUBLE) AS unit_count,
            CAST(buyers AS DOUBLE) AS buyer_count, CAST(orders AS DOUBLE) AS order_count,
            {cents("gross")} AS gross_sales_amount, CAST(favourites AS DOUBLE) AS product_favorite_user_count,
            coalesce({half_up("buyers", "visitors", 6)}, 0) AS derived_conversion_rate,
            coalesce({half_up("gross", "buyers", 2, 2)}, 0) AS derived_avg_order_value, source_rows AS source_row_count
        FROM spu""",
    "view_spu_monitoring": f"SELECT {SPU_LABELS} FROM spu",
    "view_spu_trial_cards": f"""
        SELECT {SPU_LABELS}, dense_rank() OVER (PARTITION BY shop_code ORDER BY gross DESC NULLS FIRST, spu) AS "销售额排名"
        FROM spu""",
    "review_spu": f"""
        SELECT 'SPU监控' AS "报表类型", '经营巡检面' AS "报表定位", shop_code AS "店铺", CAST(sales_date AS VARCHAR) AS "日期",
            spu AS "SPU", campaign AS "计划名", listing AS "链接名称", CAST(visitors AS VARCHAR) AS "商品访客量",
            CAST({half_even_units("view_tenths", "10")} AS VARCHAR) AS "商品浏览量", CAST(units AS VARCHAR) AS "销量",
            CAST(buyers AS VARCHAR) AS "买家数", CAST(orders AS VARCHAR) AS "订单数", {fixed("gross", 2)} AS "销售额",
            CAST(favourites AS VARCHAR) AS "商品收藏用户数",
            {fixed(half_even_units("buyers * 10000", "visitors"), 4)} AS "转化率",
            {fixed(half_even_units("gross", "buyers"), 2)} AS "客单价", CAST(source_rows AS VARCHAR) AS "来源行数",
            '{SPU_NOTE}' AS "说明"
        FROM spu""",
    "typed_shop_day": f"""
        SELECT CAST(shop_id + 1 AS BIGINT) AS import_file_id, CAST(shop_id AS BIGINT) AS shop_id, {STG_SHOP_COLUMNS}
        FROM shop_source""",
    "typed_sku_day": f"""
        SELECT CAST(shop_id + 1 AS BIGINT) AS import_file_id, CAST(shop_id AS BIGINT) AS shop_id,
            l_orderkey AS source_row_number, CAST(sales_date AS VARCHAR) AS sales_date, product_name, {IDENTITY}, {SKU_MONEY}
        FROM sku_line""",
    "upsert_shop_day": f"""
        SELECT CAST(shop_id AS BIGINT) AS shop_id, CAST(sales_date AS VARCHAR) AS sales_date,
            CAST(buyers AS BIGINT) AS buyer_count, CAST(orders AS BIGINT) AS order_count,
            {cents("gross")} AS gross_sales_amount, {cents("refund")} AS refund_amount,
            CAST(import_file_id AS BIGINT) AS import_file_id, row_no AS source_row_number
        FROM fact""",
    "upsert_sku_day": f"""
        SELECT {big("import_file_id", "shop_id")}, CAST(sales_date AS VARCHAR) AS sales_date, {IDENTITY}, {SKU_MONEY},
            source_rows AS source_row_count
        FROM sku_fact""",
    "upsert_dimension": """
        SELECT CAST(1 AS BIGINT) AS platform_id, coalesce(t.code, b.code) AS shop_code,
            CASE WHEN b.code IS NULL THEN t.name ELSE b.name END AS shop_name, b.code IS NOT NULL OR t.active AS is_active,
            CASE WHEN t.code IS NULL THEN -1 ELSE t.created END AS created_at
        FROM (SELECT 'shop_' || s_suppkey AS code, s_name AS name, s_suppkey % 3 <> 0 AS active, s_suppkey AS created
            FROM supplier) t
        FULL JOIN (SELECT 'shop_' || (c_custkey * 2) AS code, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name
            FROM customer) b ON b.code = t.code""",
    "seed_source_types": f"""
        SELECT c_custkey AS platform_id, code AS file_type_code,
            CASE WHEN known THEN c_name ELSE name END AS file_type_name, grain AS grain_code, CAST(1 AS BIGINT) AS version,
            CASE WHEN NOT known THEN description END AS description, NOT known AS is_active
        FROM (SELECT *, code = 'pdd_shop_daily' AND right(c_name, 1) = '0' AS known
            FROM customer, (VALUES {SEED_VALUES}) AS seed(code, name, grain, description))""",
    "register_import": """
        SELECT CAST(platform_id AS BIGINT) AS platform_id, shop_code, '/landing/' || lpad(c_custkey::VARCHAR, 12, '0') AS file_path,
            (SELECT max(o_orderkey) + 1 FROM orders) + row_number() OVER (ORDER BY c_custkey) AS import_file_id
        FROM customer JOIN shop ON shop_id = c_nationkey""",
    "update_from_join": """
        SELECT o_orderkey AS import_file_id, o_custkey AS platform_id,
            CASE WHEN o_orderstatus = 'F' THEN 'shop_daily' ELSE 'other' END AS report_type,
            CASE WHEN o_orderstatus = 'F' THEN o_custkey * 10 + 1 END AS source_file_type_id
        FROM orders""",
    "backfill_layers": f"""
        SELECT CAST(shop_id + 1 AS BIGINT) AS import_file_id, row_no AS source_row_number,
            'pdd_' || shop_id || '日报数据源' AS sheet_name,
            '{{' || concat_ws(',', '"日期":"' || sales_date || '"', '"店铺访客数":' || visitors, '"店铺浏览量":' || 3 * visitors,
                '"商品访客数":' || 2 * visitors, '"商品浏览数":' || 5 * visitors, '"成交买家数":' || buyers,
                '"成交订单数":' || orders, '"成交金额":' || {fixed("gross", 2)},
                '"成交转化率":' || {fixed("round(source_rate * 1000000)", 6)}, '"客单价":' || {fixed("round(source_aov * 100)", 2)},
                '"UV价值":' || {fixed("round(source_uv * 100)", 2)}, '"商品收藏用户数":' || favourites,
                '"退款金额":' || {fixed("refund", 2)}) || '}}' AS raw_payload,
            CAST(sales_date AS VARCHAR) AS sales_date, source_uv AS uv_value, {cents("refund")} AS refund_amount
        FROM shop_source""",
    "raw_rows_scan": """
        SELECT user_id AS import_file_id, event_id AS row_number, CASE WHEN user_id % 7 <> 0 THEN event_type END AS sheet_name,
            CAST(len(json_keys(props)) AS BIGINT) AS field_count, json_extract_string(props, '$.k') AS k_text
        FROM events""",
    "cell_rows_assemble": """
        SELECT 'pdd_' || (o_custkey % 25) AS workbook_identifier, '数据' AS sheet_name, CAST(1 AS BIGINT) AS sheet_index,
            o_orderkey + 2 AS row_number, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 26 ELSE 27 END AS BIGINT) AS width,
            CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE c_name END
                || repeat('|', 24) || o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN '|'
                ELSE '|' || CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR) END AS row_text
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "workbook_identity": """
        SELECT o_orderkey, 'pdd_' || o_custkey || '_workbook_' || year(o_orderdate) || '.xlsx' AS workbook_file_name,
            'pdd_' || o_custkey AS shop_code, 'pdd_' || o_custkey || '_workbook_' || year(o_orderdate) AS workbook_identifier
        FROM orders""",
    "header_resolution": f"""
        SELECT workbook_identifier, {SHOP_HEADER_JSON} AS source_header_variant,
            CAST(13 + CASE WHEN k % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN k % 3 = 2 THEN 4 ELSE 0 END AS BIGINT) AS header_count,
            CAST(CASE WHEN k % 5 <> 0 THEN 0 WHEN k % 3 = 2 THEN 18 ELSE 14 END AS BIGINT) AS date_column,
            concat_ws(',', CASE WHEN k % 4 <> 0 THEN o_orderpriority END,
                CASE WHEN k % 3 = 2 THEN '支付买家数,支付订单数,支付金额,支付转化率' END) AS unexpected_headers
        FROM wb""",
    "header_schema_diff": """
        SELECT workbook_identifier, CAST(16 - CASE WHEN k % 2 = 1 THEN 1 ELSE 0 END - CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END
                - CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS matched_count,
            concat_ws(',', '日期,SPU,计划名,链接名称,商品访客量,商品浏览量', CASE WHEN k % 2 = 0 THEN '支付件数' END,
                '支付买家数,成交订单数,支付金额,支付转化率', CASE WHEN k % 3 <> 0 THEN '下单率' END, '商品收藏用户数',
                CASE WHEN k % 5 <> 0 THEN '周数' END, '周销售额,月数', o_orderpriority) AS headers,
            concat_ws(',', CASE WHEN k % 3 = 0 THEN '下单率' END, CASE WHEN k % 5 = 0 THEN '周数' END) AS missing_headers,
            o_orderpriority AS unexpected_headers
        FROM wb""",
    "variant_coalesce": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 1 THEN CAST(o_totalprice AS VARCHAR)
            WHEN o_orderkey % 6 <> 0 THEN 'p' || o_orderkey END AS amount_text
        FROM orders""",
    "raw_extract": """
        SELECT o_orderkey AS row_number, '{"状态": "' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END
            || '", "金额": "' || CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR) || '"}' AS payload
        FROM orders WHERE o_orderkey % 9 <> 0""",
    "blank_to_null": f"""
        SELECT doc_id, CAST(length(v) AS BIGINT) AS n_chars, md5(v) AS digest
        FROM (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN nullif(trim(text, {BLANKS}), '') END AS v FROM documents)""",
    "extra_payload": r"""
        SELECT o_orderkey, CASE WHEN extra <> '' THEN '{' || extra || '}' END AS extra
        FROM (SELECT o_orderkey, concat_ws(', ', CASE WHEN o_orderkey % 2 = 1 THEN '"A列": "' || o_orderpriority || '"' END,
            CASE WHEN o_orderkey % 3 <> 0 THEN '"备注": "a\"b\\' || o_orderstatus || '"' END) AS extra FROM orders)""",
    "json_extract": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS net_text,
            CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS sku_text
        FROM orders""",
    "normalize_dataset": f"""
        SELECT (SELECT substr(sha256(string_agg(digest, chr(10) ORDER BY digest) || chr(10) || 'dataset_version=1'), 1, 16)
                FROM (SELECT sha256(string_agg(book || '|' || sha256(book), chr(10) ORDER BY book)) AS digest
                    FROM book GROUP BY substr(sha256(book), 1, 3))) AS batch_id,
            CAST(1 AS BIGINT) AS dataset_version, 'sku_source' AS dataset_code, 'sku_day' AS grain_code,
            book AS workbook_identifier, book || '.xlsx' AS workbook_file_name, 'pdd_' || n_nationkey AS shop_code,
            '②SKU源数据' AS sheet_name, CAST(2 AS BIGINT) AS sheet_index, row_no AS source_row_number,
            {SKU_HEADER_JSON} AS source_header_variant,
            CASE WHEN o_orderkey % 4 = 0 THEN '{{"备注": "' || o_orderstatus || '"}}' END AS source_extra_payload_json,
            day_text AS sales_date, o_orderpriority AS product_name, CAST(o_custkey AS VARCHAR) AS product_id,
            CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS merchant_sku_code, '默认' AS product_specification,
            CAST(o_orderkey % 9 AS VARCHAR) AS quantity_units, price AS gross_product_amount,
            double_price AS merchant_net_amount, 'S' || o_orderkey AS sku_id
        FROM sku_sheet JOIN book USING (book)""",
    "preview_rows": """
        SELECT book AS workbook_identifier, CAST(row_no AS VARCHAR) AS source_row_number, day_text AS sales_date,
            o_orderpriority AS product_name, CAST(o_custkey AS VARCHAR) AS product_id,
            CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE '' END AS merchant_sku_code, '默认' AS product_specification,
            CAST(o_orderkey % 9 AS VARCHAR) AS gross_quantity, price AS gross_product_amount,
            double_price AS merchant_net_amount, 'S' || o_orderkey AS sku_id
        FROM sku_sheet QUALIFY row_number() OVER (PARTITION BY book ORDER BY row_no) <= 5""",
    "sheet_detect": "SELECT workbook_identifier, '①日报数据源' || (k % 7) AS sheet_name FROM wb",
    "sheet_override": "SELECT workbook_identifier, ' SKU源数据 ' AS sheet_name FROM wb",
    "sheet_classify": "SELECT workbook_identifier, sheet_index, sheet_name, sheet_group FROM sheet",
    "classification_doc": """
        SELECT workbook_identifier, '[' || string_agg('{"sheet_index":' || sheet_index || ',"sheet_name":"' || sheet_name
            || '","sheet_group":"' || sheet_group || '"}', ',' ORDER BY sheet_index) || ']' AS document
        FROM sheet GROUP BY 1""",
    "sheet_inventory": f"""
        SELECT 'pdd_' || shop_id || '_workbook_2026' AS workbook_identifier, CAST(l_linenumber AS BIGINT) AS sheet_index,
            '①' || token AS sheet_name, count(*) AS detected_row_count,
            CASE WHEN l_linenumber = 3 THEN 'shop_daily_source' END AS sheet_role, l_linenumber = 3 AS is_relevant,
            'raw-source' AS sheet_group
        FROM line JOIN (VALUES {TOKEN_ROWS}) AS k(i, token, code) ON i = l_linenumber
        GROUP BY shop_id, l_linenumber, token""",
    "sheet_registry_inventory": """
        SELECT workbook_identifier, sheet_index, sheet_name, count(n) AS detected_row_count,
            CASE WHEN sheet_index = 2 THEN 'shop_daily_source' END AS sheet_role, sheet_index = 2 AS is_relevant
        FROM sheet LEFT JOIN sheet_row USING (workbook_identifier, sheet_index) GROUP BY 1, 2, 3""",
    "family_inventory": """
        SELECT (SELECT substr(sha256(string_agg(digest, chr(10) ORDER BY digest) || chr(10) || 'dataset_version=1'), 1, 16)
                FROM (SELECT sha256(string_agg(w || '|' || sha256(w), chr(10) ORDER BY w)) AS digest
                    FROM wb_file GROUP BY substr(sha256(w), 1, 3))) AS batch_id,
            workbook_identifier, '/in/' || w AS workbook_path, w || '.xlsx' AS workbook_file_name, 'pdd_' || length(w) AS shop_code,
            sheet_name, sheet_index, sheet_group, count(n) AS detected_row_count
        FROM sheet JOIN wb_file ON w = workbook_identifier LEFT JOIN sheet_row USING (workbook_identifier, sheet_index)
        GROUP BY ALL""",
    "sheet_shape": """
        SELECT * FROM (WITH book_state AS (
            SELECT coalesce(f.w, s.workbook_identifier) AS b, f.w IS NOT NULL AS registered, s.workbook_identifier IS NOT NULL AS has_sheet
            FROM wb_file f FULL JOIN (SELECT DISTINCT workbook_identifier FROM sheet) s ON f.w = s.workbook_identifier),
        stray AS (
            SELECT workbook_identifier AS b, count(DISTINCT sheet_index) AS n FROM sheet_row r
            WHERE NOT EXISTS (SELECT 1 FROM sheet s WHERE s.workbook_identifier = r.workbook_identifier AND s.sheet_index = r.sheet_index)
            GROUP BY 1),
        state AS (
            SELECT wanted.workbook_identifier AS b, i, count(r.n) AS rows, min(r.n) AS first_row
            FROM (SELECT workbook_identifier, sheet_index AS i FROM sheet WHERE sheet_index IN (2, 3)) AS wanted
            LEFT JOIN sheet_row r ON r.workbook_identifier = wanted.workbook_identifier AND r.sheet_index = i GROUP BY ALL),
        found AS (
            SELECT b, NULL AS dataset_code, CASE WHEN NOT registered THEN 'workbook is not registered'
                WHEN NOT has_sheet THEN 'workbook has no sheet' WHEN n > 0 THEN n || ' sheets with rows are not listed' END AS reason
            FROM book_state LEFT JOIN stray USING (b)
            UNION ALL
            SELECT bs.b, code, CASE WHEN st.b IS NULL THEN 'one sheet must be named for it, not 0'
                WHEN rows = 0 THEN 'its sheet has no rows' WHEN first_row <> 1 THEN 'its first row is not the header row' END
            FROM book_state bs JOIN (VALUES ('shop_daily_source', 2), ('sku_source', 3), ('spu_source', -1)) AS k(code, pos) ON bs.registered
            LEFT JOIN state st ON st.b = bs.b AND st.i = pos)
        SELECT b AS workbook_identifier, dataset_code, reason FROM found WHERE reason IS NOT NULL) AS violations""",
    "dq_rules": RULES_SQL,
    "normalize_family": FAMILY_SQL,
    "schema_manifest": SCHEMA_MANIFEST_SQL,
    "run_manifest": """
        SELECT 'b' AS batch_id, CAST(1 AS BIGINT) AS dataset_version, 'run' AS entry, NULL AS name, NULL AS workbook_file_name,
            NULL AS file_hash, CAST(NULL AS BIGINT) AS row_count, count(*) AS workbook_count FROM nation
        UNION ALL
        SELECT 'b', 1, 'dataset', code, NULL, NULL, count(o_orderkey), NULL
        FROM family LEFT JOIN orders ON o_orderkey % 7 = i AND o_orderkey % 11 <> 0 GROUP BY code
        UNION ALL
        SELECT 'b', 1, 'workbook', book, book || '.xlsx', sha256(book), NULL, NULL FROM book""",
    "dataset_row_counts": f"""
        SELECT 'pdd_' || shop_id || '_workbook_2026' AS workbook_identifier, code AS dataset_code, count(*) AS row_count
        FROM line JOIN (VALUES {TOKEN_ROWS}) AS k(i, token, code) ON i = l_linenumber GROUP BY shop_id, code""",
    "batch_fingerprint": """
        SELECT o_custkey, substr(sha256(string_agg(digest, chr(10) ORDER BY digest)
            || chr(10) || 'dataset_version=1'), 1, 16) AS batch_id
        FROM (
            SELECT o_custkey, substr(sha256(workbook_identifier), 1, 3) AS bucket,
                sha256(string_agg(workbook_identifier || '|'
                    || sha256(CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR)), chr(10) ORDER BY workbook_identifier)) AS digest
            FROM wb GROUP BY 1, 2)
        GROUP BY 1""",
    "excel_date": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 4 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS sales_date
        FROM orders""",
    "lenient_decimal": """
        SELECT l_orderkey, CAST(sum(CASE WHEN l_linenumber > 4 THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END)
            AS DOUBLE) / 100 AS total, count(*) AS line_count
        FROM lineitem GROUP BY 1""",
    "required_columns_missing": f"""
        SELECT workbook_identifier, string_agg(name, ', ' ORDER BY name) AS missing_columns
        FROM wb, (VALUES {", ".join(f"('{n}')" for n in REQUIRED)}) AS r(name)
        WHERE (length(name) + k) % 7 = 0 GROUP BY 1""",
    "dq_duplicate_keys": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
            CASE WHEN l_linestatus = 'O' THEN 'O' ELSE '' END AS status_key, count(*) AS row_count
        FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "dq_orphans": """
        SELECT o_orderkey AS order_id, CAST(1 AS BIGINT) AS row_count FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "dq_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM sku_stg"
        for c in ("shop_id", "sales_date", "product_name", "merchant_sku_code", "product_specification", "sku_id")
    ),
    "dq_lineage": """
        SELECT 'labels' AS parent, 'missing' AS problem, count(*) FILTER (WHERE doc_id IS NULL) AS rows FROM documents
        UNION ALL
        SELECT 'labels', 'orphan', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL
        SELECT 'region', 'missing', count(*) FILTER (WHERE lang = 'en') FROM documents
        UNION ALL
        SELECT 'region', 'orphan', count(*) FROM documents WHERE lang <> 'en' AND lang NOT IN (SELECT r_name FROM region)""",
    "dq_lineage_delta": """
        SELECT p AS parent, problem, CASE problem || p WHEN 'missingraw' THEN count(*) FILTER (WHERE row_no IS NULL)
            WHEN 'missingshops' THEN count(*) FILTER (WHERE shop IS NULL)
            WHEN 'orphanshops' THEN count(*) FILTER (WHERE shop NOT IN (SELECT n_nationkey FROM nation))
            ELSE count(*) FILTER (WHERE row_no NOT IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey % 7 = 3)) END AS rows
        FROM (SELECT CASE WHEN l_linenumber <> 4 THEN l_orderkey + CASE WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END END AS row_no,
                CASE WHEN l_linenumber <> 5 THEN l_suppkey % 27 END AS shop FROM lineitem WHERE l_suppkey % 7 = 3),
            (VALUES ('raw'), ('shops')) AS a(p), (VALUES ('missing'), ('orphan')) AS b(problem)
        GROUP BY p, problem""",
    "metric_outliers": """
        SELECT * FROM (
            SELECT CAST(shop_id AS BIGINT) AS shop_id, CAST(sales_date AS VARCHAR) AS sales_date, 'conversion_rate' AS metric,
                source_rate AS source, derived_rate AS derived FROM shop_source
            WHERE abs(round(source_rate * 10000) - round(derived_rate * 10000)) > 50
            UNION ALL
            SELECT shop_id, CAST(sales_date AS VARCHAR), 'uv_value', source_uv, derived_uv FROM shop_source
            WHERE abs(round(source_uv * 100) - round(derived_uv * 100)) > 0.5)""",
    "metric_reconcile": """
        SELECT CAST(shop_id AS BIGINT) AS shop_id, count(*) AS row_count,
            count(source_rate - derived_rate) AS conversion_rate_compared,
            count(source_aov - derived_aov) AS avg_order_value_compared, count(source_uv - derived_uv) AS uv_value_compared,
            count(*) FILTER (WHERE abs(round(source_rate * 10000) - round(derived_rate * 10000)) > 50) AS conversion_rate_off,
            count(*) FILTER (WHERE abs(round(source_aov * 100) - round(derived_aov * 100)) > 0.5) AS avg_order_value_off,
            count(*) FILTER (WHERE abs(round(source_uv * 100) - round(derived_uv * 100)) > 0.5) AS uv_value_off
        FROM shop_source GROUP BY 1""",
    "missing_identifiers": " UNION ALL ".join(
        f"""SELECT CAST(shop_id AS BIGINT) AS shop_id, '{c}' AS column_name,
            count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM sku_stg GROUP BY 1"""
        for c in ("product_id", "sku_id", "merchant_sku_code", "product_specification")
    ),
    "identifier_conflicts": " UNION ALL ".join(
        f"""SELECT '{a}->{b}' AS rule, {a} AS id, count(DISTINCT {b}) AS counterparts FROM sku_stg
            WHERE {a} IS NOT NULL GROUP BY {a} HAVING count(DISTINCT {b}) > 1"""
        for a, b in (
            ("sku_id", "product_id"),
            ("sku_id", "merchant_sku_code"),
            ("merchant_sku_code", "sku_id"),
            ("product_id", "product_specification"),
            ("product_id", "sku_id"),
        )
    ),
    "duplicate_source_rows": f"""
        SELECT CAST(shop_id AS BIGINT) AS shop_id, CAST(sales_date AS VARCHAR) AS sales_date, {IDENTITY},
            count(*) AS source_rows
        FROM sku_line GROUP BY sku_line.shop_id, sku_line.sales_date, {IDENTITY} HAVING count(*) > 1""",
    "coverage_by_shop": """
        SELECT CAST(shop_id AS BIGINT) AS shop_id, CAST(count(*) + sum(second) AS BIGINT) AS row_count,
            CAST(min(sales_date) AS VARCHAR) AS first_date, CAST(max(sales_date) AS VARCHAR) AS last_date
        FROM fact GROUP BY 1""",
    "layer_reconcile": """
        SELECT CAST(shop_id AS BIGINT) AS shop_id, raw_rows, staging_rows, fact_rows
        FROM (SELECT shop_id, count(*) AS raw_rows FROM sku_line GROUP BY 1)
        LEFT JOIN (SELECT shop_id, count(*) AS staging_rows FROM sku_stg GROUP BY 1) USING (shop_id)
        LEFT JOIN (SELECT shop_id, count(*) AS fact_rows FROM sku_fact GROUP BY 1) USING (shop_id)""",
    "csv_roundtrip": """
        SELECT doc_id, ' "' || lang || '",' || chr(10) || ' ' AS note, CAST(length(nullif(text, '')) AS BIGINT) AS n_chars,
            md5(nullif(text, '')) AS text_md5
        FROM documents""",
    "raw_rows_json_roundtrip": """
        SELECT user_id AS import_file_id, event_id AS row_number, event_type AS sheet_name,
            json_extract_string(props, '$.k') AS k_text
        FROM events""",
    "dataset_roundtrip": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "file_fingerprint": "SELECT s_suppkey, sha256(s_name || chr(10)) AS workbook_file_hash FROM supplier",
    "platform_lookup": """
        SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE r_name = 'ASIA'""",
    "published_snapshot": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'",
    "appended_imports": """
        SELECT o_orderkey AS row_number, o_orderpriority AS sheet_name, CAST(1 AS BIGINT) AS import_file_id
        FROM orders WHERE o_custkey % 3 = 1 AND o_orderpriority = '1-URGENT'""",
    "salted_lookup_join": """
        SELECT l_returnflag, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
            count(*) OVER flag AS flag_rows, max(l_orderkey) OVER flag AS last_order
        FROM lineitem WINDOW flag AS (PARTITION BY l_returnflag)""",
    "distributed_rank": """
        SELECT l_orderkey, l_linenumber, l_returnflag, units,
            dense_rank() OVER (ORDER BY units DESC NULLS FIRST, l_orderkey) AS rank_all,
            dense_rank() OVER (PARTITION BY l_returnflag ORDER BY units NULLS LAST) AS rank_in_flag
        FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag,
            CASE WHEN l_quantity > 1 THEN CAST(l_quantity AS BIGINT) END AS units FROM lineitem)""",
    "latest_imports": """
        SELECT o_orderkey AS import_file_id FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC LIMIT 5""",
    "union_ids": "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer",
    "concat_datasets": """
        SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS brand FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
        UNION ALL SELECT p_partkey, NULL, p_brand FROM part""",
    "resolve_shop": """
        SELECT c_custkey AS platform_id, c_custkey AS shop_id, o_orderpriority AS platform_code, c_mktsegment AS shop_code
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING'""",
    "lookup_by_code": "SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#11'",
}


#: Sort keys of written outputs and the positions that follow from them.
ORDERED = {
    "ordered_review_daily": ("review_daily", '"店铺", "日期"', '"店铺", "日期"'),
    "ordered_review_monthly": ("review_monthly", '"店铺", "月份"', '"店铺", "月份"'),
    "ordered_review_spu": (
        "review_spu",
        '"店铺", "日期", CAST("销售额" AS DOUBLE) AS "销售额", "SPU", "计划名", "链接名称"',
        '"店铺" DESC, "日期" DESC, CAST("销售额" AS DOUBLE) DESC, "SPU", "计划名", "链接名称"',
    ),
    "ordered_snapshot": (
        "spu_snapshot",
        "shop_code, sales_date, spu_name, campaign_name, listing_name",
        "shop_code, sales_date, spu_name, campaign_name, listing_name",
    ),
}
BODIES |= {
    name: f"SELECT {shown}, row_number() OVER (ORDER BY {order}) AS position FROM ({BODIES[source]}) AS report"
    for name, (source, shown, order) in ORDERED.items()
}
FAMILY_KEYS = "workbook_identifier, sheet_index, source_row_number"
BODIES["ordered_family"] = f"""
    SELECT dataset_code, {FAMILY_KEYS}, row_number() OVER (PARTITION BY dataset_code ORDER BY {FAMILY_KEYS}) AS position
    FROM ({FAMILY_SQL}) AS family_rows"""

ORACLE = {name: sql(body) for name, body in BODIES.items()}
