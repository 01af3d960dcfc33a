"""Readers for landed data. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..contracts import DATASETS, SOURCE_TYPE_SEEDS
from ..functions import json_text_map

RAW_ROW_SCHEMA = "import_file_id int, row_number int, sheet_name string, raw_payload map<string,string>"
RAW_TEXT_SCHEMA = "import_file_id int, row_number int, sheet_name string, raw_payload string"

# Fixed value: workbook file names.
WORKBOOK_NAME = r"^(pdd_[0-9]+)_workbook_([0-9]{4})\.xlsx$"


def read_raw_rows(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw rows; the payload maps each header to its text."""
    return spark.read.schema(RAW_ROW_SCHEMA).parquet(path)


def read_raw_rows_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows exported as JSON lines, payload as JSON text."""
    return parse_raw_payload(spark.read.schema(RAW_TEXT_SCHEMA).option("mode", "FAILFAST").json(path))


def parse_raw_payload(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"raw_payload": json_text_map(F.col("raw_payload")), "sheet_name": F.nullif("sheet_name", F.lit(""))}
    )


def read_csv_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header into a typed schema; one bad value fails the whole read.

    Quoted values may hold line breaks, so a file is read by one task: the
    writer's part files are the unit of parallel work.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_ordered(spark: SparkSession, path: str, by: tuple[str, ...] = (), name: str = "position") -> DataFrame:
    """Rows of a written folder with the position at which they lie in it, from 1, in each group of ``by`` folders.

    Positions are those of the files: by part number, then by row inside a part.
    Each part's rows carry their own index, so only one row per file is counted up.
    """
    number = F.regexp_extract("_file", r"^part-([0-9]+)", 1).cast("int").alias("_part")
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = rows.groupBy(*by, "_file").agg(F.count(F.lit(1)).alias("_n")).select(*by, "_file", "_n", number)
    files = W.partitionBy(*by).orderBy("_part", "_file").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*by, "_file", F.coalesce(F.sum("_n").over(files), F.lit(0)).alias("_start"))
    placed = rows.join(starts, [*by, "_file"])
    return placed.withColumn(name, F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_start")


def out_of_order(positioned: DataFrame, order: list[tuple[str, bool]], by: tuple[str, ...] = (), name: str = "position") -> DataFrame:
    """Rows that lie behind a row that belongs after them; ``order`` has columns and whether they descend (NULL then last).

    Every row is compared with the one before it; rows are dealt by ranges of positions, whose first rows are given the last
    row of the range before, so that part boundaries are checked as well and no task has the whole table.
    """
    keys = [c for c, _ in order]
    size = 100_000
    block = F.floor((F.col(name) - 1) / size)
    rows = positioned.select(*by, name, *keys)
    # The last row of a range is also the one before the first of the next.
    own = rows.withColumn("_block", block)
    lent = own.filter(F.col(name) % size == 0).withColumn("_block", F.col("_block") + 1)
    window = W.partitionBy(*by, "_block").orderBy(name)
    both = own.unionByName(lent)
    for k in keys:
        both = both.withColumn(f"_before_{k}", F.lag(k).over(window))
    fine = F.lit(True)
    for k, descending in reversed(order):
        a, b = (F.col(k), F.col(f"_before_{k}")) if descending else (F.col(f"_before_{k}"), F.col(k))
        first = a.isNull() & b.isNotNull()
        fine = F.coalesce(a < b, F.lit(False)) | first | (a.eqNullSafe(b) & fine)
    has_before = F.lag(F.lit(1)).over(window).isNotNull()
    return both.withColumn("_fine", ~has_before | fine).filter(~F.col("_fine")).select(*by, name, *keys)


def read_dataset(spark: SparkSession, root: str, code: str) -> DataFrame:
    """One normalised dataset; a missing path fails the read."""
    if code not in DATASETS:
        raise KeyError(f"unknown dataset {code}")
    return spark.read.parquet(f"{root}/datasets/{code}")


def read_family(spark: SparkSession, root: str, code: str | None = None) -> DataFrame:
    """The datasets of a family that were written side by side: all of them, or the folder of one."""
    every = spark.read.parquet(f"{root}/datasets")
    if code is None:
        return every
    if code not in DATASETS:
        raise KeyError(f"unknown dataset {code}")
    return every.filter(F.col("dataset_code") == code)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def workbook_identity(df: DataFrame, path_col: str) -> DataFrame:
    """Add file name, shop code and workbook id from the path; an unexpected name fails the job."""
    name = file_name(F.col(path_col))
    shop = F.regexp_extract(name, WORKBOOK_NAME, 1)
    year = F.regexp_extract(name, WORKBOOK_NAME, 2)
    problem = F.raise_error(F.concat(F.lit("not a workbook of the family: "), name)).cast("string")
    return df.withColumns(
        {
            "workbook_file_name": name,
            "shop_code": F.when(shop == "", problem).otherwise(shop),
            "workbook_identifier": F.concat(shop, F.lit("_workbook_"), year),
        }
    )


def file_fingerprints(spark: SparkSession, glob: str) -> DataFrame:
    """SHA-256 of every file that matches, in folders that match also of those below; each file is hashed in the task that
    reads it. Many folders are listed by the tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob)
    return files.select(F.col("path").alias("workbook_path"), F.sha2("content", 256).alias("workbook_file_hash"))


def workbook_files(spark: SparkSession, glob: str) -> DataFrame:
    """Registry of a workbook family: path, file name, shop, workbook id, hash. No match is an error."""
    found = workbook_identity(file_fingerprints(spark, glob), "workbook_path")
    if found.isEmpty():
        raise FileNotFoundError(f"no workbook at {glob}")
    return found


def seed_rows(platforms: DataFrame) -> DataFrame:
    """The seed source types for every given platform."""
    seeds = F.array(
        *[
            F.struct(
                F.lit(code).alias("file_type_code"),
                F.lit(name).alias("file_type_name"),
                F.lit(grain).alias("grain_code"),
                F.lit(1).alias("version"),
                F.lit(description).alias("description"),
                F.lit(True).alias("is_active"),
            )
            for code, name, grain, description in SOURCE_TYPE_SEEDS
        ]
    )
    return platforms.select("platform_id", F.inline(seeds))
