"""Sheet inventory, classification, structural guards and run documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import DATASET_VERSION, DATASETS, Contract
from ..functions import strip
from ..session import materialise

# Sheet groups and the name of the reserved image sheet.
RAW_SOURCE = "raw-source"
IGNORE = "ignore"
MIXED = "mixed/presentation"
RESERVED_SHEET = "WpsReserved_CellImgList"

# Hexadecimal digits of an id's digest that choose the bucket of its line in a batch fingerprint.
BUCKET_DIGITS = 3


def classify_sheet(name: Column) -> Column:
    trimmed = strip(name)
    raw = reduce(lambda a, b: a | b, [F.contains(trimmed, F.lit(c.sheet_token)) for c in DATASETS.values()])
    return (
        F.when(raw, F.lit(RAW_SOURCE))
        .when((trimmed == RESERVED_SHEET) | trimmed.rlike(r"^Sheet\p{Nd}+\z"), F.lit(IGNORE))
        .otherwise(F.lit(MIXED))
    )


def listed_sheets(rows: DataFrame, by: list[str]) -> DataFrame:
    """The sheets that have rows: a registry for inputs that come without one, in which empty sheets are not seen."""
    return rows.select(*by, "sheet_index", "sheet_name").distinct()


def sheet_row_counts(rows: DataFrame, by: list[str], sheets: DataFrame | None = None) -> DataFrame:
    """Rows per sheet of the registry ``sheets`` (by, sheet_index, sheet_name), header and blank rows included.

    The registry drives the result: a sheet without rows counts 0, and so does one
    whose only landed row has no number.
    """
    key = [*by, "sheet_index", "sheet_name"]
    counts = rows.groupBy(*key).agg(F.count("row_number").alias("detected_row_count"))
    if sheets is None:
        return counts
    counted = sheets.select(*key).join(counts, key, "left")
    return counted.withColumn("detected_row_count", F.coalesce("detected_row_count", F.lit(0)))


def sheet_candidates(inventory: DataFrame, token: str, by: list[str]) -> DataFrame:
    """Per workbook: the sheet names that contain the token, sorted (a workbook holds few sheets)."""
    hit = F.contains(F.col("sheet_name"), F.lit(token))
    return inventory.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.when(hit, F.col("sheet_name")))).alias("matches")
    )


def detect_sheet(inventory: DataFrame, token: str, by: list[str]) -> DataFrame:
    """The one sheet per workbook whose name contains the token; none or several fail the job."""
    found = sheet_candidates(inventory, token, by)
    problem = (
        F.when(F.size("matches") == 0, F.lit(f"no sheet is named for {token}"))
        .when(
            F.size("matches") > 1,
            F.concat(F.lit(f"more than one sheet is named for {token}: "), F.array_join("matches", ", ")),
        )
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(F.col("matches")[0])
    return found.select(*by, checked.alias("sheet_name"))


def choose_sheet(inventory: DataFrame, token: str, by: list[str], override: str | None = None) -> DataFrame:
    """Sheet to load per workbook; an explicit name replaces detection and must exist."""
    if override is None:
        return detect_sheet(inventory, token, by)
    found = inventory.groupBy(*by).agg(F.count_if(F.col("sheet_name") == override).alias("matches"))
    missing = F.raise_error(F.lit(f"the workbook has no sheet {override}")).cast("string")
    return found.select(*by, F.when(F.col("matches") == 0, missing).otherwise(F.lit(override)).alias("sheet_name"))


def sheet_inventory(counts: DataFrame, contract: Contract, target: Column) -> DataFrame:
    """Inventory rows of an import: the target sheet has the contract's role, others have none."""
    relevant = F.col("sheet_name") == target
    role = F.nullif(F.when(relevant, F.lit(contract.role)).otherwise(F.lit("")), F.lit(""))
    return counts.withColumns({"sheet_role": role, "is_relevant": relevant})


def family_inventory(counts: DataFrame, batch_id: str) -> DataFrame:
    """Inventory dataset of a whole run, grouped by kind of sheet and sorted."""
    return (
        counts.withColumn("batch_id", F.lit(batch_id))
        .withColumn("sheet_group", classify_sheet(F.col("sheet_name")))
        .orderBy("workbook_identifier", "sheet_index")
    )


def sheet_shape_violations(
    rows: DataFrame, contracts: list[Contract], sheets: DataFrame | None = None, files: DataFrame | None = None
) -> DataFrame:
    """What breaks the layout rules, with the reason: workbook_identifier, dataset_code (NULL for whole workbooks), reason.

    ``files`` (registered workbooks) and ``sheets`` (their sheets) drive the check, so that a workbook without rows and a
    sheet without rows are seen; by default both come from the rows. Rows and sheets of workbooks that are not registered,
    and rows of sheets that are not listed, are violations, too. The rows are read once, for all datasets.
    """
    book, key = "workbook_identifier", ["workbook_identifier", "sheet_index", "sheet_name"]
    landed = rows.groupBy(*key).agg(F.min("row_number").alias("first_row"), F.count("row_number").alias("n"))
    if sheets is None or files is None:
        landed = materialise(landed)
    listed = (landed if sheets is None else sheets).select(*key, F.lit(True).alias("listed"))
    per_sheet = listed.join(landed, key, "full")
    known = (listed if files is None else files).select(book, F.lit(True).alias("registered")).distinct()
    rules = F.array(*[F.struct(F.lit(c.code).alias("dataset_code"), F.lit(c.sheet_token).alias("token")) for c in contracts])
    tagged = per_sheet.withColumn("_hits", F.filter(rules, lambda r: F.contains(F.col("sheet_name"), r["token"])))
    whole = F.struct(F.lit(None).cast("string").alias("dataset_code"), F.lit(None).cast("string").alias("token"))
    # One row per sheet and dataset it is named for, and one for the workbook itself.
    spread = tagged.select("*", F.inline(F.concat("_hits", F.array(whole))))
    per_book = spread.groupBy(book, "dataset_code").agg(
        F.count_if("listed").alias("matches"),
        F.min(F.when(F.col("listed"), F.coalesce("n", F.lit(0)))).alias("rows"),
        F.min("first_row").alias("first_row"),
        F.count_if(F.col("listed").isNull()).alias("unlisted"),
    )
    expected = known.select(book, "registered", F.explode(F.array(*[F.lit(c.code) for c in contracts], F.lit(None))).alias("dataset_code"))
    same = (expected[book] == per_book[book]) & expected["dataset_code"].eqNullSafe(per_book["dataset_code"])
    both = expected.join(per_book, same, "full").select(
        F.coalesce(expected[book], per_book[book]).alias(book),
        F.coalesce(expected["dataset_code"], per_book["dataset_code"]).alias("dataset_code"),
        "registered",
        F.coalesce("matches", F.lit(0)).alias("matches"),
        "rows",
        "first_row",
        F.coalesce("unlisted", F.lit(0)).alias("unlisted"),
    )
    of_book = (
        F.when(F.col("registered").isNull(), F.lit("workbook is not registered"))
        .when(F.col("matches") == 0, F.lit("workbook has no sheet"))
        .when(F.col("unlisted") > 0, F.concat(F.col("unlisted"), F.lit(" sheets with rows are not listed")))
    )
    of_dataset = (
        F.when(F.col("matches") != 1, F.concat(F.lit("one sheet must be named for it, not "), F.col("matches")))
        .when(F.col("rows") == 0, F.lit("its sheet has no rows"))
        .when(F.col("first_row") != 1, F.lit("its first row is not the header row"))
    )
    reason = F.when(F.col("dataset_code").isNull(), of_book).when(F.col("registered"), of_dataset)
    return both.select(book, "dataset_code", reason.alias("reason")).filter("reason is not null")


def require_none(violations: DataFrame, what: str) -> None:
    """Fail with up to ten examples when there is any violation."""
    examples = violations.limit(10).collect()
    if examples:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in examples))


def classification_doc(inventory: DataFrame) -> DataFrame:
    """One document per workbook with its sheets in index order (a workbook holds few sheets)."""
    sheets = F.sort_array(F.collect_list(F.struct("sheet_index", "sheet_name", "sheet_group")))
    return inventory.groupBy("workbook_identifier").agg(sheets.alias("sheets"))


def schema_manifest(resolved: DataFrame, batch_id: str, row_counts: DataFrame) -> DataFrame:
    """Per dataset and workbook: headers, mapping, missing and unexpected headers and row count (0 without data rows)."""
    grains = F.create_map(*[x for code, c in DATASETS.items() for x in (F.lit(code), F.lit(c.grain))])
    return (
        resolved.select(
            "dataset_code",
            "workbook_identifier",
            "sheet_name",
            "headers",
            "mapping",
            "missing_headers",
            "unexpected_headers",
        )
        .join(row_counts, ["dataset_code", "workbook_identifier"], "left")
        .select(
            "dataset_code",
            F.lit(batch_id).alias("batch_id"),
            F.lit(DATASET_VERSION).alias("dataset_version"),
            F.try_element_at(grains, F.col("dataset_code")).alias("grain_code"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            "workbook_identifier",
            "sheet_name",
            "headers",
            "mapping",
            "missing_headers",
            "unexpected_headers",
        )
    )


def dataset_row_counts(normalised: DataFrame, by: list[str] | None = None) -> DataFrame:
    return normalised.groupBy(*(by or ["dataset_code"])).agg(F.count(F.lit(1)).alias("row_count"))


def run_manifest(files: DataFrame, counts: DataFrame, batch_id: str) -> DataFrame:
    """Rows of a run manifest: one for the run with its number of workbooks, one per dataset with its row count, also if it
    has none, one per workbook with its file name and hash. ``counts`` has dataset_code and row_count."""
    stamp = [F.lit(batch_id).alias("batch_id"), F.lit(DATASET_VERSION).alias("dataset_version")]
    none, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def entry(kind, name=text, file_name=text, file_hash=text, row_count=none, workbook_count=none):
        shown = {"name": name, "workbook_file_name": file_name, "file_hash": file_hash, "row_count": row_count, "workbook_count": workbook_count}
        return [*stamp, F.lit(kind).alias("entry"), *[c.alias(n) for n, c in shown.items()]]

    run = files.agg(F.count(F.lit(1)).alias("n")).select(*entry("run", workbook_count=F.col("n")))
    codes = files.sparkSession.createDataFrame([(c,) for c in DATASETS], "dataset_code string")
    summed = counts.groupBy("dataset_code").agg(F.sum("row_count").alias("row_count"))
    every = codes.join(F.broadcast(summed), "dataset_code", "left")  # seven rows at most
    datasets = every.select(*entry("dataset", F.col("dataset_code"), row_count=F.coalesce("row_count", F.lit(0))))
    workbooks = files.select(*entry("workbook", F.col("workbook_identifier"), F.col("workbook_file_name"), F.col("workbook_file_hash")))
    return run.unionByName(datasets).unionByName(workbooks)


def batch_ids(files: DataFrame, by: list[str]) -> DataFrame:
    """Fingerprint of each group of files, independent of their order; one rule for groups of every size.

    The ``id|hash`` lines go to 4,096 buckets by the first characters of the id's
    digest. Each bucket's sorted lines are digested, and so are the sorted bucket
    digests with the dataset version; the result is cut to 16 characters. No
    value ever holds more than one bucket's lines.
    """
    line = F.concat_ws("|", "workbook_identifier", "workbook_file_hash")
    ordered = F.sort_array(F.collect_list(F.struct("workbook_identifier", line.alias("line"))))
    text = F.array_join(F.transform(ordered, lambda e: e["line"]), "\n")
    bucket = F.substring(F.sha2(F.col("workbook_identifier").cast("binary"), 256), 1, BUCKET_DIGITS).alias("_bucket")
    per_bucket = files.groupBy(*by, bucket).agg(F.sha2(text, 256).alias("_digest"))
    joined = F.array_join(F.sort_array(F.collect_list("_digest")), "\n")
    whole = F.concat(joined, F.lit(f"\ndataset_version={DATASET_VERSION}"))
    digested = per_bucket.groupBy(*by).agg(whole.alias("_w"))
    return digested.select(*by, F.substring(F.sha2("_w", 256), 1, 16).alias("batch_id"))


def batch_id(files: DataFrame) -> str:
    """Fingerprint of one run over all its files."""
    return batch_ids(files.withColumn("_run", F.lit(1)), ["_run"]).first()["batch_id"]
