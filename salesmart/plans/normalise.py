"""Sheet rows of a workbook family -> normalised datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import CANONICAL_COLUMNS, DATASET_COLUMNS, DATASET_VERSION, DATASETS, LINEAGE_TYPES, Contract
from ..functions import normalise_date_text
from ..operators.headers import extra_payload, extract_raw_rows, mapped_values, resolve_headers, with_header_positions
from ..operators.joins import lookup_join
from ..session import materialise

FILE_COLUMNS = ["workbook_path", "workbook_file_name", "workbook_file_hash", "shop_code"]


def contract_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    return rows.filter(F.contains(F.col("sheet_name"), F.lit(contract.sheet_token)))


def header_rows(sheets: DataFrame) -> DataFrame:
    """Header row of every sheet: positions and names."""
    return with_header_positions(sheets.filter(F.col("row_number") == 1)).drop("cells", "row_number")


def sheet_payloads(rows: DataFrame, contract: Contract, strict: bool, sheet_name: str | None = None) -> DataFrame:
    """Data rows of one dataset with header mapping and payload; blank rows are dropped.

    The sheets are those whose name contains the contract's token, or one named sheet.
    """
    sheets = contract_rows(rows, contract) if sheet_name is None else rows.filter(F.col("sheet_name") == sheet_name)
    resolved = resolve_headers(header_rows(sheets), contract, strict=strict)
    sheet = ["workbook_identifier", "sheet_index"]
    data = sheets.filter(F.col("row_number") != 1)
    # One row per sheet: resolved once, then measured and joined from the written copy.
    lookup = materialise(resolved.select(*sheet, "positions", "mapping", "source_header_variant"))
    with_header = lookup_join(data, lookup, sheet, "left")
    return extract_raw_rows(_with_header_or_fail(with_header))


def family_headers(rows: DataFrame) -> DataFrame:
    """One written row per sheet and dataset it belongs to: header positions, mapping, missing and unexpected headers.

    The header rows are read once, for all contracts.
    """
    first = materialise(header_rows(rows.filter(_any_dataset())))
    parts = [
        resolve_headers(contract_rows(first, c), c, strict=False).withColumn("dataset_code", F.lit(code)) for code, c in DATASETS.items()
    ]
    return materialise(concat_datasets(parts))


def _any_dataset() -> Column:
    return F.size(_datasets_of_sheet()) > 0


def _datasets_of_sheet() -> Column:
    """Codes of the datasets whose token the sheet's name contains."""
    rules = F.array(*[F.struct(F.lit(code).alias("code"), F.lit(c.sheet_token).alias("token")) for code, c in DATASETS.items()])
    return F.transform(F.filter(rules, lambda r: F.contains(F.col("sheet_name"), r["token"])), lambda r: r["code"])


def normalize_family(rows: DataFrame, files: DataFrame, batch_id: str, resolved: DataFrame | None = None) -> DataFrame:
    """Rows of all datasets on the shared schema, from one pass over the data rows; every metric stays text.

    A row is tagged with the datasets of its sheet and finds their headers in one
    lookup (``resolved``, from ``family_headers``), so a workbook that holds most
    of the rows stays spread out. Blank rows are dropped.
    """
    resolved = family_headers(rows) if resolved is None else resolved
    sheet = ["workbook_identifier", "sheet_index", "dataset_code"]
    tagged = rows.filter(F.col("row_number") != 1).withColumn("dataset_code", F.explode(_datasets_of_sheet()))
    headed = lookup_join(tagged, resolved.select(*sheet, "positions", "mapping", "source_header_variant"), sheet, "left")
    payloads = extract_raw_rows(_with_header_or_fail(headed))
    named = lookup_join(payloads, files.select("workbook_identifier", *FILE_COLUMNS), ["workbook_identifier"], "left")
    return _on_shared_schema(named, batch_id, CANONICAL_COLUMNS)


def _with_header_or_fail(headed: DataFrame) -> DataFrame:
    no_header = F.raise_error(
        F.concat(F.lit("sheet without header row: "), F.col("workbook_identifier"), F.lit(" "), F.col("sheet_name"))
    ).cast("string")
    variant = F.when(F.col("positions").isNull(), no_header).otherwise(F.col("source_header_variant"))
    return headed.withColumn("source_header_variant", variant)


def _on_shared_schema(rows: DataFrame, batch_id: str, names: list[str]) -> DataFrame:
    """Payload rows with dataset_code, mapping and file columns -> lineage, canonical and extra columns.

    Fields that a dataset does not have are not in its mapping, so they are NULL.
    """
    grains = F.create_map(*[x for code, c in DATASETS.items() for x in (F.lit(code), F.lit(c.grain))])
    stamped = rows.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "dataset_version": F.lit(DATASET_VERSION),
            "grain_code": F.try_element_at(grains, F.col("dataset_code")),
            "source_row_number": F.col("row_number"),
        }
    )
    stamped = mapped_values(stamped, names)
    values = {n: F.col(n) if n in names else F.lit(None).cast("string") for n in CANONICAL_COLUMNS}
    if "sales_date" in names:
        values["sales_date"] = normalise_date_text(F.col("sales_date"))
    values["source_extra_payload_json"] = extra_payload(F.col("raw_payload"), F.col("mapping"))
    lineage = {
        name: values.pop(name) if name in values else F.col(name).cast(kind) for name, kind in LINEAGE_TYPES.items()
    }
    return stamped.select(*[c.alias(n) for n, c in {**lineage, **values}.items()]).select(*DATASET_COLUMNS)


def normalize_dataset(rows: DataFrame, files: DataFrame, contract: Contract, batch_id: str) -> DataFrame:
    """Rows of one dataset on the shared schema; every metric stays text.

    The headers are resolved once per sheet and joined to the data rows as a
    lookup, so a workbook that holds most of the rows stays spread out.
    """
    payloads = sheet_payloads(rows, contract, strict=False).withColumn("dataset_code", F.lit(contract.code))
    named = lookup_join(payloads, files.select("workbook_identifier", *FILE_COLUMNS), ["workbook_identifier"], "left")
    return _on_shared_schema(named, batch_id, contract.field_names)


def sorted_dataset(df: DataFrame) -> DataFrame:
    """Rows of each dataset in the order of workbook, sheet and row, through all of its part files."""
    return df.orderBy("dataset_code", "workbook_identifier", "sheet_index", "source_row_number")


def concat_datasets(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
