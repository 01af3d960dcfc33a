"""Writers: CSV, Parquet, JSON, published rebuilds, append-only import layers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from . import storage


def write_csv(df: DataFrame, path: str, columns: list[str], order: list | None = None) -> None:
    """CSV with header in a fixed column order; sorted output keeps its order across part files."""
    out = df.orderBy(*order) if order else df
    (
        out.select(*[f"`{c}`" for c in columns])
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_datasets(df: DataFrame, root: str) -> None:
    """Datasets side by side, one folder for each dataset_code, in one pass. Sorted input keeps its order across part files."""
    df.write.option("compression", "zstd").partitionBy("dataset_code").parquet(f"{root}/datasets")


def write_manifest(df: DataFrame, path: str) -> None:
    """JSON lines, keys in name order."""
    df.select(*[f"`{c}`" for c in sorted(df.columns)]).write.mode("overwrite").json(path)


def _versions(spark: SparkSession, root: str, last_part: str = "") -> list[int]:
    """Complete versions below ``root``: those whose (last) write job has committed."""
    listed = [n for n in storage.names(spark, root) if n.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in listed if storage.exists(spark, f"{root}/{n}{last_part}/_SUCCESS"))


def next_version(spark: SparkSession, root: str) -> str:
    """The folder of a version that is claimed for the caller alone, also against other writers."""
    taken = [int(n.split("=")[1]) for n in storage.names(spark, root) if n.startswith("version=")]
    return f"{root}/version={storage.claim_next(spark, f'{root}/_claims', max(taken, default=0))}"


def current_version_path(spark: SparkSession, root: str, last_part: str = "") -> str:
    """Newest complete version; one of several parts is complete once ``last_part`` is written."""
    done = _versions(spark, root, last_part)
    if not done:
        raise FileNotFoundError(f"nothing published below {root}")
    return f"{root}/version={done[-1]}"


def publish(df: DataFrame, root: str) -> str:
    """Full rebuild: write the next version beside the current one.

    Readers see a version only after its job has committed, so a failed rebuild
    leaves the previous result in place. Of two rebuilds at once each has its own
    version, and the one that claimed its number last is the current one.
    """
    target = next_version(df.sparkSession, root)
    write_dataset(df, target)
    return target


def read_published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_version_path(spark, root))


@contextmanager
def opened(spark: SparkSession, root: str, last_part: str = "") -> Iterator[str]:
    """The current version's folder, which ``retire`` leaves alone until the block ends."""
    path = current_version_path(spark, root, last_part)
    pin = f"{root}/_pins/{path.rsplit('=', 1)[1]}-{uuid.uuid4().hex}"
    storage.place_new(spark, pin, "")
    try:
        yield path
    finally:
        storage.remove(spark, pin)


def retire(spark: SparkSession, root: str, keep: int = 2, min_age: float = 86_400.0, last_part: str = "") -> list[str]:
    """Remove old versions: all but the newest ``keep`` complete ones, those in use, and those younger than ``min_age``
    seconds. Incomplete ones that are older belong to failed runs and go, too. Returns what was removed."""
    done = _versions(spark, root, last_part)
    pins = [p for p in storage.names(spark, f"{root}/_pins") if storage.age_seconds(spark, f"{root}/_pins/{p}") < min_age]
    kept = {*done[-keep:], *(int(p.split("-")[0]) for p in pins)}
    gone = []
    for name in storage.names(spark, root):
        path = f"{root}/{name}"
        if name.startswith("version=") and int(name.split("=")[1]) not in kept and storage.age_seconds(spark, path) >= min_age:
            storage.remove(spark, path)
            gone.append(path)
    return gone


def refresh_snapshot(df: DataFrame, root: str) -> str:
    """Replace a snapshot as a whole."""
    return publish(df, root)


def write_import(df: DataFrame, path: str, import_id: int) -> None:
    """The rows of one claimed import in their own folder of a layer.

    Writers that append to one folder at the same time share its scratch space and lose each other's files; these never meet.
    """
    rows = df.drop("import_file_id").hint("rebalance")
    write_dataset(rows, f"{path}/import_file_id={import_id}")


def append_import(df: DataFrame, path: str) -> None:
    """Append one run's rows to a layer laid out by import."""
    (
        df.hint("rebalance", "import_file_id")
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy("import_file_id")
        .parquet(path)
    )
