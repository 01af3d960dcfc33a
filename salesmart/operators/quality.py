"""Integrity rules and data-quality analyses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safe_ratio
from ..session import materialise
from .joins import lookup_join


def duplicate_keys(df: DataFrame, keys: list[str | Column], name: str = "row_count") -> DataFrame:
    """Keys that occur more than once; a key part may be an expression."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    Children are counted per key and parents de-duplicated before the join, so a
    frequent key is one row on either side. A NULL key is no reference and is
    not an orphan.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = child.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.join(parent.select(*keys).distinct(), keys, "left_anti")


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its NULL count, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def lineage_violations(df: DataFrame, parents: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per parent: rows whose reference is NULL and rows whose reference does not exist."""
    absent = {
        name: reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]) for name, (_, keys) in parents.items()
    }
    counted = df.agg(*[F.count_if(a).alias(name) for name, a in absent.items()])
    nulls = counted.unpivot([], list(parents), "parent", "rows").select("parent", F.lit("missing").alias("problem"), "rows")
    parts = [nulls]
    for name, (parent, keys) in parents.items():
        lost = orphans(df, parent, keys).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
        parts.append(lost.select(F.lit(name).alias("parent"), F.lit("orphan").alias("problem"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def lineage_delta(
    df: DataFrame, parents: dict[str, tuple[DataFrame, list[str]]], import_id: int, column: str = "import_file_id"
) -> DataFrame:
    """``lineage_violations`` of the rows of one import.

    The import is a literal, so of layers kept by import only its folder is opened,
    of the child and of every parent that the import is part of the key of.
    """
    own = {
        name: (parent.filter(F.col(column) == import_id) if column in keys else parent, keys)
        for name, (parent, keys) in parents.items()
    }
    return lineage_violations(df.filter(F.col(column) == import_id), own)


def metric_outliers(staging: DataFrame, tolerance: str = "0.005") -> DataFrame:
    """The rows of ``metric_reconcile`` with a ratio that is off, one row per ratio: its source and its derived value."""
    flagged = metric_reconcile(staging, tolerance)
    ratios = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("decimal(18,6)").alias("source"), F.col(f"derived_{m}").cast("decimal(18,6)").alias("derived"), F.col(f"{m}_differs").alias("off"))
            for m in ("conversion_rate", "avg_order_value", "uv_value")
        ]
    )
    return flagged.select("shop_id", "sales_date", F.inline(ratios)).filter("off").drop("off")


def missing_columns(
    required: list[str], present: DataFrame, by: list[str], column: str = "column_name", groups: DataFrame | None = None
) -> DataFrame:
    """Per group of ``present``: required names it lacks, joined in name order; complete groups are left out.

    ``groups`` lists the groups that there should be; one without any column lacks all.

    The list of required names is part of the rule, so each group's state is one
    flag per name and is combined map-side.
    """
    names = sorted(required)
    flags = present.groupBy(*by).agg(
        *[F.max(F.col(column) == n).alias(f"_has_{i}") for i, n in enumerate(names)]
    )
    if groups is not None:
        flags = groups.select(*by).distinct().join(flags, by, "left")
    absent = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.col(f"_has_{i}"), F.lit(False)), F.lit(n)) for i, n in enumerate(names)])
    )
    listed = flags.select(*by, F.array_join(absent, ", ").alias("missing_columns"))
    return listed.filter(F.col("missing_columns") != "")


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The frame itself when it has all required columns, else an error that names the missing ones."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def metric_reconcile(staging: DataFrame, tolerance: str = "0.005") -> DataFrame:
    """Staging rows with derived ratios beside the source ratios and a flag for each that differs."""
    visitors, buyers, sales = F.col("shop_visitor_count"), F.col("buyer_count"), F.col("gross_sales_amount")
    derived = {
        "conversion_rate": safe_ratio(buyers, visitors, 4),
        "avg_order_value": safe_ratio(sales, buyers, 2),
        "uv_value": safe_ratio(sales, visitors, 2),
    }
    limit = F.lit(tolerance).cast("decimal(12,6)")
    out = staging
    for name, value in derived.items():
        out = out.withColumn(f"derived_{name}", value).withColumn(
            f"{name}_differs", F.abs(F.col(name) - F.col(f"derived_{name}")) > limit
        )
    return out


def reconcile_metrics(staging: DataFrame, by: list[str], tolerance: str = "0.005") -> DataFrame:
    """Per group: comparable rows and rows off by more than the tolerance, for each metric."""
    flagged = metric_reconcile(staging, tolerance)
    metrics = ["conversion_rate", "avg_order_value", "uv_value"]
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(f"{m}_differs").alias(f"{m}_compared") for m in metrics],
        *[F.count_if(f"{m}_differs").alias(f"{m}_off") for m in metrics],
    )


def missing_identifiers(staging: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    counts = staging.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(by, columns, "column_name", "missing_count")


def identifier_conflicts(staging: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Ids that map to more than one counterpart, for each (id, counterpart) pair.

    Rows equal in all identity columns are folded and written once. The hub is the
    column with most pairs. A hub id of one identity has one counterpart in each
    column and is one counterpart of each of them, so such identities are folded to
    their other columns and a count. Only the other hub ids are expanded into one
    entry per pair; entries are de-duplicated map-side and then counted per id, so
    no id's counterparts are gathered in one place.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    hub = max(columns, key=lambda c: sum(c in pair for pair in pairs))
    identities = materialise(staging.select(*columns).distinct())
    counted = identities.filter(F.col(hub).isNotNull()).groupBy(hub).agg(F.count(F.lit(1)).alias("_identities"))
    repeated = materialise(counted.filter("_identities > 1").select(hub, F.lit(True).alias("_repeated")))
    tagged = lookup_join(identities, repeated, [hub])
    others = [c for c in columns if c != hub]
    folded = materialise(tagged.filter("_repeated is null").groupBy(*others).agg(F.count(hub).alias("_hubs")))

    def entry(a: str, b: str, counterpart: Column) -> Column:
        return F.struct(F.lit(f"{a}->{b}").alias("rule"), F.col(a).alias("id"), counterpart.alias("counterpart"))

    expanded = tagged.filter("_repeated").select(F.inline(F.array(*[entry(a, b, F.col(b)) for a, b in pairs])))
    if direct := [entry(a, b, F.col(b)) for a, b in pairs if hub not in (a, b)]:
        expanded = expanded.unionByName(folded.select(F.inline(F.array(*direct))))
    found = (
        expanded.filter("id is not null and counterpart is not null")
        .distinct()
        .select("rule", "id", F.lit(1).cast("bigint").alias("counterpart"))
    )
    if to_hub := [entry(a, b, F.col("_hubs")) for a, b in pairs if b == hub and a != hub]:
        found = found.unionByName(folded.select(F.inline(F.array(*to_hub))).filter("id is not null"))
    return found.groupBy("rule", "id").agg(F.sum("counterpart").alias("counterparts")).filter("counterparts > 1")


def coverage(df: DataFrame, by: list[str], date_col: str = "sales_date") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    )


def reconcile_layers(layers: dict[str, DataFrame], by: str) -> DataFrame:
    """Rows per group in each layer, side by side; a group absent from a layer counts zero."""
    tagged = reduce(
        DataFrame.unionByName, [df.select(by, F.lit(name).alias("layer")) for name, df in layers.items()]
    )
    return tagged.groupBy(by).agg(
        *[F.count_if(F.col("layer") == name).alias(f"{name}_rows") for name in layers]
    )
