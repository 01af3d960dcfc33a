"""End-to-end jobs: load a workbook, build the dataset family, refresh the snapshot, export reviews."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..contracts import DATASETS, SHOP_DAILY_LOAD, SKU_DAILY_LOAD, SOURCE_TYPE_SEEDS, Contract
from ..operators import inventory as inv
from ..operators.headers import preview
from ..operators.merge import insert_missing, month_state, next_id, upsert, upsert_months, with_month
from ..operators.quality import duplicate_keys
from ..operators.windows import latest_date, trailing_days
from ..session import materialise, scratch
from ..sources import commits, sinks, storage
from ..sources.landed import read_family, seed_rows
from . import facts, reporting, reviews
from .normalise import family_headers, normalize_family, sheet_payloads, sorted_dataset
from .staging import SHOP_DAY_FACT, SKU_MONEY, narrow_fact, to_stg_shop_day, to_stg_sku_day

# The platform and the notes of its imports.
PLATFORM = ("pdd", "Pinduoduo")
IMPORT_NOTES = {
    "pdd_shop_daily": "PDD workbook-level shop daily load from 日报数据源",
    "pdd_sku_daily": "PDD workbook-level SKU daily load from SKU源数据",
}

PLATFORMS = "platform_id int, platform_code string, platform_name string"
SHOPS = "shop_id int, platform_id int, shop_code string, shop_name string, is_active boolean, created_at timestamp_ntz"
FILE_TYPES = (
    "source_file_type_id int, platform_id int, file_type_code string, file_type_name string, grain_code string, "
    "version int, description string, is_active boolean"
)
IMPORT_FILES = (
    "import_file_id int, source_file_type_id int, platform_id int, shop_id int, file_path string, file_name string, "
    "sheet_name string, file_hash string, row_count_raw int, imported_at timestamp_ntz, notes string"
)


#: Tables that are rewritten whole and facts that are kept by month: what a snapshot names.
CONTROL = {"platforms": PLATFORMS, "shops": SHOPS, "source_file_types": FILE_TYPES, "import_files": IMPORT_FILES}
FACTS = ("fact_shop_day", "fact_sku_day")


@dataclass(frozen=True)
class Warehouse:
    """Folder layout: control tables and facts behind the snapshots of ``commits``, layers by import beside them."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def control_table(spark: SparkSession, wh: Warehouse, name: str, schema: str, at: commits.Snapshot | None = None) -> DataFrame:
    at = commits.current(spark, wh.root) if at is None else at
    return commits.read(spark, wh.root, at, name) if name in at.schemas else spark.createDataFrame([], schema)


def layer(
    spark: SparkSession, wh: Warehouse, name: str, schema: str | None = None, at: commits.Snapshot | None = None
) -> DataFrame:
    """A table of the warehouse as a snapshot has it: a control table, a fact, or the rows of committed imports of a layer.

    Rows of imports that are under way or failed are in a layer's folders, but
    their ids are not in the register, so they are never seen. An empty frame of
    ``schema`` stands for a table before its first write.
    """
    at = commits.current(spark, wh.root) if at is None else at
    if name in at.schemas or name in FACTS:
        return commits.read(spark, wh.root, at, name)
    if name in CONTROL:
        return control_table(spark, wh, name, schema or CONTROL[name], at)
    try:
        rows = spark.read.parquet(wh.path(name))
    except AnalysisException as problem:
        if schema is None or problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    committed = control_table(spark, wh, "import_files", IMPORT_FILES, at).select("import_file_id")
    return rows.join(committed, "import_file_id", "left_semi")


def initialise(spark: SparkSession, wh: Warehouse) -> None:
    """Seed the platform and the source types; rows that exist already stay as they are."""

    def change(at: commits.Snapshot) -> commits.Change:
        platforms = control_table(spark, wh, "platforms", PLATFORMS, at)
        seed = spark.createDataFrame([(next_id(platforms, "platform_id"), *PLATFORM)], PLATFORMS)
        platforms = materialise(insert_missing(platforms, seed, ["platform_code"]))
        types = control_table(spark, wh, "source_file_types", FILE_TYPES, at)
        # Numbers of the nine seeds follow the highest id in use.
        base = next_id(types, "source_file_type_id") - 1
        own = seed_rows(platforms.filter(F.col("platform_code") == PLATFORM[0]))
        codes = [r["file_type_code"] for r in own.select("file_type_code").collect()]
        number = F.create_map(*[x for i, c in enumerate(codes, 1) for x in (F.lit(c), F.lit(base + i))])
        seeds = own.withColumn("source_file_type_id", number[F.col("file_type_code")])
        merged = insert_missing(types, seeds, ["platform_id", "file_type_code", "version"])
        return commits.write_whole(wh.root, "platforms", platforms) | commits.write_whole(wh.root, "source_file_types", merged)

    commits.commit(spark, wh.root, change)


def _refreshed(wh: Warehouse, name: str, table: DataFrame, row: dict, keys: list[str], id_col: str, once: tuple = ()) -> tuple[commits.Change, int]:
    """The change that gives a control table ``row`` by its keys, and the row's id; no change where it says the same.

    ``once`` columns are set by the first write only.
    """
    spark = table.sparkSession
    matches = F.lit(True)
    for key in keys:
        matches = matches & (F.col(key) == row[key])
    known = table.filter(matches).first()
    if known and all(known[c] == v for c, v in row.items() if c not in once):
        return commits.Change(), known[id_col]
    number = known[id_col] if known else next_id(table, id_col)
    batch = spark.createDataFrame([{**row, id_col: number}], table.schema)
    update = [c for c in table.columns if c not in (*keys, *once, id_col)]
    merged = upsert(table, batch, keys, update, [id_col, *once]).select(*table.columns)
    return commits.write_whole(wh.root, name, merged), number


@dataclass(frozen=True)
class Workbook:
    """One landed workbook: its sheet rows, its list of sheets and where it came from.

    ``sheets`` (workbook_identifier, sheet_index, sheet_name) also lists the sheets without rows; without such a list only
    sheets with rows are known.
    """

    rows: DataFrame
    path: str
    file_hash: str
    shop_code: str
    shop_name: str
    sheet_name: str | None = None
    sheets: DataFrame | None = None


def _target_sheet(book: Workbook, contract: Contract) -> tuple[DataFrame, str]:
    by = ["workbook_identifier"]
    sheets = inv.listed_sheets(book.rows, by) if book.sheets is None else book.sheets
    counts = materialise(inv.sheet_row_counts(book.rows, by, sheets))
    chosen = inv.choose_sheet(counts, contract.sheet_token, by, book.sheet_name).first()
    if chosen is None:
        raise ValueError(f"the workbook has no sheet at all: {book.path}")
    return counts, chosen["sheet_name"]


def preview_workbook(book: Workbook, contract: Contract) -> DataFrame:
    """First rows of the sheet that a load would take."""
    _, sheet = _target_sheet(book, contract)
    return preview(sheet_payloads(book.rows, contract, True, sheet), contract, ["workbook_identifier"])


def _load(spark: SparkSession, wh: Warehouse, book: Workbook, contract: Contract, now: dt.datetime, fact: str, batch_of, keys, columns) -> int:
    """Load a workbook as one commit; returns the import's id.

    Everything that can fail on bad input is computed before the first write. The
    id is claimed, so no other load gets it; inventory, raw rows and staging are
    written below it, and become visible together with the register entry, the
    shop, platform and source type, and the merged months of the fact. A load
    that fails anywhere leaves readers where they were and is repeated as a new
    import.
    """
    counts, sheet = _target_sheet(book, contract)
    payloads = materialise(sheet_payloads(book.rows, contract, True, sheet).drop("mapping", "source_header_variant"))
    typed = to_stg_shop_day if contract is SHOP_DAILY_LOAD else to_stg_sku_day
    staged = materialise(typed(payloads.withColumns({"import_file_id": F.lit(0), "shop_id": F.lit(0)})))
    if contract is SHOP_DAILY_LOAD:
        inv.require_none(duplicate_keys(staged, ["sales_date"]), "date occurs twice in one import")
    n_rows = payloads.count()
    code, name, grain, description = next(x for x in SOURCE_TYPE_SEEDS if x[0] == contract.code)
    written: dict[int, tuple[int, DataFrame]] = {}  # by shop id: the claimed import and the batch of facts
    merged: dict[tuple, commits.Change] = {}

    def write_layers(shop_id: int, at: commits.Snapshot) -> tuple[int, DataFrame]:
        known = control_table(spark, wh, "import_files", IMPORT_FILES, at)
        import_id = storage.claim_next(spark, wh.path("_claims/import_file_id"), next_id(known, "import_file_id") - 1)
        stamp = {"import_file_id": F.lit(import_id), "shop_id": F.lit(shop_id)}
        staging = staged.withColumns(stamp)
        layers = {
            "import_file_sheets": inv.sheet_inventory(counts, contract, F.lit(sheet)),
            "raw_import_rows": payloads.select("row_number", "sheet_name", "raw_payload"),
            f"stg_{contract.grain}": staging,
        }
        for name, rows in layers.items():
            sinks.write_import(rows, wh.path(name), import_id)
        return import_id, with_month(batch_of(staging).withColumn("created_at", F.lit(now).cast("timestamp_ntz")))

    def change(at: commits.Snapshot) -> commits.Change:
        table = {n: control_table(spark, wh, n, schema, at) for n, schema in CONTROL.items()}
        platform = {"platform_code": PLATFORM[0], "platform_name": PLATFORM[1]}
        out, platform_id = _refreshed(wh, "platforms", table["platforms"], platform, ["platform_code"], "platform_id")
        shop = {"platform_id": platform_id, "shop_code": book.shop_code, "shop_name": book.shop_name, "is_active": True, "created_at": now}
        more, shop_id = _refreshed(wh, "shops", table["shops"], shop, ["platform_id", "shop_code"], "shop_id", ("created_at",))
        out |= more
        kind = {"platform_id": platform_id, "file_type_code": code, "version": 1, "file_type_name": name, "grain_code": grain, "description": description, "is_active": True}
        type_keys = ["platform_id", "file_type_code", "version"]
        more, type_id = _refreshed(wh, "source_file_types", table["source_file_types"], kind, type_keys, "source_file_type_id")
        out |= more
        if shop_id not in written:
            written[shop_id] = write_layers(shop_id, at)
        import_id, tagged = written[shop_id]
        months = [r[commits.MONTH] for r in tagged.select(commits.MONTH).distinct().collect()]
        state = (shop_id, month_state(at, fact, months))
        if state not in merged:
            merged[state] = upsert_months(spark, wh.root, at, fact, tagged, keys, columns, keep_cols=["created_at"])
        entry = (
            import_id, type_id, platform_id, shop_id, book.path, book.path.rsplit("/", 1)[-1],
            sheet, book.file_hash, n_rows, now, IMPORT_NOTES[contract.code],
        )
        register = table["import_files"].unionByName(spark.createDataFrame([entry], IMPORT_FILES))
        return out | merged[state] | commits.write_whole(wh.root, "import_files", register.coalesce(1))

    commits.commit(spark, wh.root, change)
    return next(reversed(written.values()))[0]


def load_shop_day(spark: SparkSession, wh: Warehouse, book: Workbook, now: dt.datetime) -> int:
    """Workbook -> raw rows -> staging -> shop-day facts, as one commit. Each run is a new import."""
    columns = [*SHOP_DAY_FACT, "import_file_id", "source_row_number"]
    with scratch(spark):
        return _load(spark, wh, book, SHOP_DAILY_LOAD, now, "fact_shop_day", narrow_fact, facts.SHOP_DAY_KEYS, columns)


def load_sku_day(spark: SparkSession, wh: Warehouse, book: Workbook, now: dt.datetime) -> int:
    """Workbook -> raw rows -> staging -> SKU-day facts, as one commit; the new totals replace older ones."""
    columns = [*SKU_MONEY, "import_file_id", "source_row_count", "product_name"]
    with scratch(spark):
        return _load(spark, wh, book, SKU_DAILY_LOAD, now, "fact_sku_day", facts.named_sku_day, facts.SKU_DAY_KEYS, columns)


# --- reports over the stored layers -------------------------------------------------------------------------------------


def latest_stored_date(spark: SparkSession, wh: Warehouse, at: commits.Snapshot, fact: str) -> dt.date | None:
    """The latest date of a stored fact, from its newest month alone."""
    months = at.months(fact)
    if not months:
        return None
    newest = commits.read(spark, wh.root, at, fact).filter(F.col(commits.MONTH) == max(months))
    return latest_date(newest, "sales_date")


def report(spark: SparkSession, wh: Warehouse, name: str, at: commits.Snapshot | None = None, snapshot_root: str | None = None) -> DataFrame:
    """One of the nine reporting views from the stored layers, all as one snapshot has them.

    The 30-day views read the months of their window only. The two monitoring
    views read the product snapshot published below ``snapshot_root``.
    """
    if name in ("spu_monitoring", "spu_trial_cards"):
        view = reporting.spu_monitoring(sinks.read_published(spark, snapshot_root))
        return view if name == "spu_monitoring" else reporting.spu_trial_cards(view)
    at = commits.current(spark, wh.root) if at is None else at
    per_sku = name in ("sku_daily", "sku_rank_30d", "product_cards_30d")
    fact_name, staging_name = ("fact_sku_day", "stg_sku_day") if per_sku else ("fact_shop_day", "stg_shop_day")
    fact, latest = layer(spark, wh, fact_name, at=at), None
    if name.endswith("_30d"):
        latest = latest_stored_date(spark, wh, at, fact_name)
        fact = trailing_days(fact, "sales_date", latest)
    shops = control_table(spark, wh, "shops", SHOPS, at)
    if per_sku:
        view = reporting.sku_daily(fact.drop(commits.MONTH), shops)
        plans = {"sku_daily": lambda: view, "sku_rank_30d": lambda: reporting.sku_rank_30d(view, latest), "product_cards_30d": lambda: reporting.product_cards_30d(view, latest)}
    else:
        layers = (fact.drop(commits.MONTH), shops, layer(spark, wh, staging_name, at=at))
        plans = {
            "shop_daily": lambda: reporting.shop_daily(*layers),
            "shop_monthly": lambda: reporting.shop_monthly(*layers),
            "top_summary_daily": lambda: reporting.top_summary_daily(reporting.shop_daily(*layers)),
            "shop_rank_30d": lambda: reporting.shop_rank_30d(reporting.shop_daily(*layers), latest),
        }
    return plans[name]()


RUN_MANIFEST = "/run_manifest"


def build_family(
    spark: SparkSession, rows: DataFrame, files: DataFrame, root: str, sheets: DataFrame | None = None
) -> str:
    """Write the seven datasets with their manifests as the next version below ``root``.

    ``files`` are the registered workbooks and ``sheets`` all their sheets, also empty ones (without a list: those with
    rows); what does not fit them fails before anything is written. The sheet rows are read for the layout check and the
    inventory, for the headers, and once for the data of all datasets. The run manifest is written last; readers see the
    version from then on.
    """
    with scratch(spark):
        return _build_family(spark, rows, files, root, sheets)


def _build_family(spark: SparkSession, rows: DataFrame, files: DataFrame, root: str, sheets: DataFrame | None) -> str:
    key = "workbook_identifier"
    sheets = inv.listed_sheets(rows, [key]) if sheets is None else sheets
    counts = materialise(inv.sheet_row_counts(rows, [key], sheets))
    inv.require_none(inv.sheet_shape_violations(rows, list(DATASETS.values()), sheets, files), "workbook layout")
    batch = inv.batch_id(files)
    target = sinks.next_version(spark, root)
    resolved = family_headers(rows)
    # Sorting samples its input, so the rows are derived once and read twice.
    sinks.write_datasets(sorted_dataset(materialise(normalize_family(rows, files, batch, resolved))), target)
    written = materialise(inv.dataset_row_counts(read_family(spark, target), ["dataset_code", key]))
    sinks.write_manifest(inv.schema_manifest(resolved, batch, written), f"{target}/schema_manifests")
    listed = inv.family_inventory(counts.join(files.drop("workbook_file_hash"), key), batch)
    sinks.write_dataset(listed, f"{target}/sheet_inventory")
    document = inv.classification_doc(listed).join(files.select(key, "workbook_path"), key)
    sinks.write_manifest(document.withColumn("batch_id", F.lit(batch)), f"{target}/sheet_classification")
    sinks.write_manifest(inv.run_manifest(files, written, batch), f"{target}{RUN_MANIFEST}")
    return target


def family_dataset(spark: SparkSession, root: str, code: str) -> DataFrame:
    return read_family(spark, sinks.current_version_path(spark, root, RUN_MANIFEST), code)


def refresh_monitoring(spark: SparkSession, family_root: str, snapshot_root: str, now: dt.datetime) -> str:
    """Replace the product monitoring snapshot from the current SPU dataset."""
    with scratch(spark):
        return sinks.refresh_snapshot(reviews.spu_snapshot(family_dataset(spark, family_root, "spu_source"), now), snapshot_root)


def export_reviews(spark: SparkSession, wh: Warehouse, family_root: str, root: str, now: dt.datetime) -> str:
    """Write the three review exports as CSV and their manifest as the next version below ``root``."""
    layers = (
        layer(spark, wh, "fact_shop_day"),
        control_table(spark, wh, "shops", SHOPS),
        layer(spark, wh, "stg_shop_day"),
    )
    daily, monthly = reviews.review_daily(*layers), reviews.review_monthly(*layers)
    spu = reviews.review_spu(family_dataset(spark, family_root, "spu_source"))
    target = sinks.next_version(spark, root)
    for name, df in {"日报_review": daily, "月报_review": monthly, "SPU监控_review": spu}.items():
        sinks.write_csv(df, f"{target}/{name}", df.columns)
    sinks.write_manifest(reviews.review_manifest(daily, monthly, spu, now), f"{target}{RUN_MANIFEST}")
    return target
