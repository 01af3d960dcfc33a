"""Keyed upserts, insert-if-absent, update-from and import registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_label
from ..session import materialise
from ..sources import commits
from .joins import lookup_join, measured_small
from .ranking import row_index

_SIDE = "_side"


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    update_cols: list[str],
    keep_cols: list[str] | None = None,
) -> DataFrame:
    """Target rows with the batch applied on top.

    A batch row replaces all ``update_cols`` of its key, with NULL too;
    ``keep_cols`` stay as first written; keys absent from the batch stay. A key
    twice in one batch or in the stored rows, or a NULL key part in either,
    fails the job. One shuffle on the keys; key filters above it reach both
    inputs.
    """
    keep_cols = keep_cols or []
    wanted = [*keys, *update_cols, *keep_cols]
    both = target.select(*wanted, F.lit(0).alias(_SIDE)).unionByName(batch.select(*wanted, F.lit(1).alias(_SIDE)))
    merged = both.groupBy(*keys).agg(
        *[F.max_by(c, _SIDE).alias(c) for c in update_cols],
        *[F.min_by(c, _SIDE).alias(c) for c in keep_cols],
        F.sum(_SIDE).alias("_from_batch"),
        F.sum(1 - F.col(_SIDE)).alias("_stored"),
    )
    return merged.filter(_valid_key(keys)).filter(_single_stored(keys)).select(*wanted)


def newest_import(rows: DataFrame, keys: list[str], update_cols: list[str], import_order: str) -> DataFrame:
    """State after upserting all imports one after the other, in one aggregation.

    ``rows`` holds every import; per key the row of the latest import that has
    the key is kept. A key twice in one import, or a NULL key part, fails the job.
    """
    merged = rows.groupBy(*keys).agg(
        *[F.max_by(c, import_order).alias(c) for c in update_cols if c != import_order],
        F.max(import_order).alias(import_order),
        (F.count(F.lit(1)) - F.count_distinct(import_order) + 1).alias("_from_batch"),
    )
    return merged.filter(_valid_key(keys)).select(*keys, *update_cols)


def _shown(keys: list[str]) -> Column:
    return F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def _single_stored(keys: list[str]) -> Column:
    problem = F.raise_error(F.concat(F.lit("Key is stored twice: "), _shown(keys))).cast("boolean")
    return F.when(F.col("_stored") > 1, problem).otherwise(F.lit(True))


def _valid_key(keys: list[str]) -> Column:
    shown = _shown(keys)
    no_null = F.lit(True)
    for key in keys:
        no_null = no_null & F.col(key).isNotNull()
    return (
        F.when(~no_null, F.raise_error(F.concat(F.lit("NULL in key: "), shown)).cast("boolean"))
        .when(
            F.col("_from_batch") > 1,
            F.raise_error(F.concat(F.lit("Key occurs twice in one batch: "), shown)).cast("boolean"),
        )
        .otherwise(F.lit(True))
    )


def upsert_small_batch(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    update_cols: list[str],
    keep_cols: list[str] | None = None,
) -> DataFrame:
    """``upsert`` for a stored target and a batch that was measured to be small.

    The batch is broadcast, so of the target only the keys are shuffled, to hold
    stored rows to the same rule as ``upsert``. Its key columns are read again to
    find the batch keys that are new.
    """
    keep_cols = keep_cols or []
    stored = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("_stored"), F.lit(0).alias("_from_batch"))
    stored.filter(_valid_key(keys)).filter(_single_stored(keys)).agg(F.count(F.lit(1))).collect()
    wanted = [*keys, *update_cols, *keep_cols]
    checked = batch.groupBy(*keys).agg(
        *[F.any_value(c).alias(c) for c in [*update_cols, *keep_cols]], F.count(F.lit(1)).alias("_from_batch")
    )
    rows = checked.filter(_valid_key(keys)).select(*wanted)
    incoming = rows.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update_cols])
    replaced = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in update_cols]
    kept = target.join(F.broadcast(incoming), keys, "left").select(*keys, *replaced, *keep_cols)
    # At most one key per batch row.
    known = target.select(*keys).join(F.broadcast(rows.select(*keys)), keys, "left_semi")
    return kept.unionByName(rows.join(F.broadcast(known), keys, "left_anti").select(*wanted))


def with_month(batch: DataFrame, date_col: str = "sales_date") -> DataFrame:
    """A batch with its sales month, written so that repeated tries read it again and do not derive it again."""
    return materialise(batch.withColumn(commits.MONTH, month_label(F.col(date_col))))


def upsert_months(
    spark: SparkSession,
    root: str,
    at: commits.Snapshot,
    table: str,
    tagged: DataFrame,
    keys: list[str],
    update_cols: list[str],
    date_col: str = "sales_date",
    keep_cols: list[str] | None = None,
) -> commits.Change:
    """The change that applies a batch to a fact kept by month: new folders for the months it touches.

    Months are copied, never written in place; the stored side is read by a filter on sales_month, so others are not opened.
    """
    # At most one value per calendar month.
    touched = sorted(r[commits.MONTH] for r in tagged.select(commits.MONTH).distinct().filter(F.col(commits.MONTH).isNotNull()).collect())
    if set(touched) & set(at.months(table)):
        stored = commits.read(spark, root, at, table).filter(F.col(commits.MONTH).isin(touched))
    else:
        stored = tagged.limit(0)
    if measured_small(tagged):
        # Stored rows stay in the tasks that read them, so each month keeps about its files.
        merged = upsert_small_batch(stored, tagged, keys, update_cols, keep_cols)
        out = merged.withColumn(commits.MONTH, month_label(F.col(date_col)))
    else:
        merged = upsert(stored, tagged, keys, update_cols, keep_cols)
        # Rebalancing splits a dominant month over several files.
        out = merged.withColumn(commits.MONTH, month_label(F.col(date_col))).hint("rebalance", commits.MONTH)
    return commits.write_months(root, table, out, touched)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    update_cols: list[str],
    date_col: str = "sales_date",
    keep_cols: list[str] | None = None,
    table: str = "fact",
) -> commits.Snapshot:
    """Apply a batch to a stored fact as one commit, on the newest state if another writer was faster.

    Readers see all its months or none; a run that fails leaves no trace and is repeated.
    """
    tagged = with_month(batch, date_col)
    months = [r[commits.MONTH] for r in tagged.select(commits.MONTH).distinct().collect()]
    done: dict[tuple, commits.Change] = {}

    def change(at: commits.Snapshot) -> commits.Change:
        state = month_state(at, table, months)
        if state not in done:  # months that another commit left alone are not merged again
            done[state] = upsert_months(spark, path, at, table, tagged, keys, update_cols, date_col, keep_cols)
        return done[state]

    return commits.commit(spark, path, change)


def month_state(at: commits.Snapshot, table: str, months: list[str]) -> tuple:
    """The folders that some months have in a snapshot."""
    return tuple(at.folders.get(f"{table}/{m}") for m in months)


def only_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not have yet."""
    return rows.join(target.select(*keys), keys, "left_anti")


def insert_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the rows with a new key; existing rows are left alone."""
    return target.unionByName(only_missing(target, rows, keys).select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set columns from the matching source row; unmatched rows keep their value."""
    incoming = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched")
    )
    joined = lookup_join(target, incoming, keys, "left")
    kept = [c for c in target.columns if c not in columns]
    updated = [
        F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns
    ]
    return joined.select(*kept, *updated)


def union_ids(new: DataFrame, existing: DataFrame) -> DataFrame:
    return new.union(existing).distinct()


def next_id(table: DataFrame, id_col: str) -> int:
    top = table.agg(F.max(id_col).alias("top")).first()["top"]
    return 1 if top is None else top + 1


def register_imports(files: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """New rows of the import register, numbered after the highest id in use.

    ``order`` is a unique key of the new rows. Nothing is matched against
    earlier imports: every run is a new import.
    """
    base = next_id(files, "import_file_id") - 1
    numbered = row_index(new, order, "_number")
    return numbered.withColumn("import_file_id", F.col("_number").cast("bigint") + F.lit(base)).drop("_number")


def latest_imports(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy(F.col("imported_at").desc_nulls_first(), F.col("import_file_id").desc()).limit(n)
