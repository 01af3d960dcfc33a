"""Header rows, header resolution against a contract, and row payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..contracts import Contract
from ..functions import clean_excel_date, json_object_text, strip
from ..session import materialise
from .joins import lookup_join


def with_header_positions(df: DataFrame, cells: str = "cells") -> DataFrame:
    """Add ``headers`` (names in order of first appearance) and ``positions`` (name, idx).

    Blank names are dropped; a repeated name reads its last column. Each step is
    a column of its own, so the lambdas read arrays instead of rebuilding them.
    """
    named = (
        df.withColumn("_columns", F.sort_array(F.map_keys(cells)))
        .withColumn("_names", F.transform("_columns", lambda k: strip(F.element_at(cells, k))))
        .withColumns(
            {
                "_backwards": F.reverse("_names"),
                "headers": F.array_remove(F.array_distinct("_names"), ""),
            }
        )
    )
    positions = F.transform(
        "headers",
        lambda n: F.struct(
            n.alias("name"),
            F.element_at(F.col("_columns"), -F.array_position(F.col("_backwards"), n).cast("int")).alias("idx"),
        ),
    )
    return named.withColumn("positions", positions).drop("_columns", "_names", "_backwards")


def _first_present(headers: Column, variants: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(F.array_contains(headers, v), F.lit(v)) for v in variants])


def resolve_headers(df: DataFrame, contract: Contract, headers: str = "headers", strict: bool = True) -> DataFrame:
    """Add ``mapping``, ``missing_headers``, ``unexpected_headers`` and ``source_header_variant``.

    Strict: every field needs one of its headers, otherwise the job fails and
    names all missing ones. Tolerant: unmatched fields stay out of the mapping
    and only fields with a single accepted header are reported as missing.
    """
    present = F.col(headers)
    chosen = {f"_match_{i}": _first_present(present, f.headers) for i, f in enumerate(contract.fields)}
    matched = dict(zip(contract.fields, [F.col(c) for c in chosen], strict=True))
    pairs = F.array(*[F.struct(F.lit(f.name).alias("key"), h.alias("value")) for f, h in matched.items()])
    mapping = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    missing = F.array_compact(
        F.array(
            *[
                F.when(h.isNull(), F.lit(" / ".join(f.headers)))
                for f, h in matched.items()
                if strict or len(f.headers) == 1
            ]
        )
    )
    resolved = df.withColumns(chosen).withColumn("missing_headers", missing)
    if strict:
        problem = F.concat(F.lit("no column for: "), F.array_join("missing_headers", ", "))
        resolved = resolved.withColumn(
            "mapping", F.when(F.size("missing_headers") > 0, F.raise_error(problem).cast("map<string,string>")).otherwise(mapping)
        )
    else:
        resolved = resolved.withColumn("mapping", mapping)
    return resolved.withColumns(
        {
            "unexpected_headers": F.array_except(present, F.map_values("mapping")),
            "source_header_variant": header_variant_json(F.col("mapping")),
        }
    ).drop(*chosen)


def header_variant_json(mapping: Column) -> Column:
    return json_object_text(mapping)


def row_payload(positions: Column, cells: Column) -> Column:
    """Header -> trimmed cell text for every named header; absent cells are blank."""
    return F.map_from_entries(
        F.transform(
            positions,
            lambda h: F.struct(
                h["name"].alias("key"),
                strip(F.coalesce(F.try_element_at(cells, h["idx"]), F.lit(""))).alias("value"),
            ),
        )
    )


def not_blank(payload: Column) -> Column:
    return F.exists(F.map_values(payload), lambda v: v != "")


def drop_blank_rows(df: DataFrame, payload: Column) -> DataFrame:
    """Add ``raw_payload`` and keep the rows that have any text in it.

    Exploding the filtered one-element array builds each payload once; a plain
    filter would be pushed below the projection and build it a second time.
    """
    return df.withColumn("raw_payload", F.explode(F.filter(F.array(payload), not_blank)))


def extract_raw_rows(rows: DataFrame, positions: str = "positions", cells: str = "cells") -> DataFrame:
    """Data rows that carry their sheet's header positions -> rows with ``raw_payload``, blanks dropped."""
    return drop_blank_rows(rows, row_payload(F.col(positions), F.col(cells))).drop(positions, cells)


def mapped_values(df: DataFrame, names: list[str]) -> DataFrame:
    """Add one column per canonical field name, blank as NULL, from a trimmed payload.

    Two steps, so that each map is searched once per field.
    """
    found = {
        name: F.try_element_at("raw_payload", F.try_element_at("mapping", F.lit(name)))
        for name in names
    }
    return df.withColumns(found).withColumns({n: F.nullif(F.col(n), F.lit("")) for n in found})


def extra_payload(payload: Column, mapping: Column) -> Column:
    """Non-blank cells under unmatched headers, as JSON with sorted keys; NULL when there are none."""
    used = F.map_values(mapping)
    extra = F.map_filter(payload, lambda k, v: (v != "") & ~F.array_contains(used, k))
    return F.when(F.size(extra) > 0, json_object_text(extra))


def preview(df: DataFrame, contract: Contract, by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` data rows of each sheet under canonical names; blank where there is no value.

    The last row number of each sheet's first ``n`` rows is found from the keys
    alone, so no task sorts payloads of rows that are not shown. The row limit
    sits directly above its window, so every task keeps at most ``n`` rows per
    sheet before the shuffle.
    """
    window = W.partitionBy(*by).orderBy("row_number")
    keys = df.select(*by, "row_number").withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n)
    last = materialise(keys.groupBy(*by).agg(F.max("row_number").alias("_last")))
    near = lookup_join(df, last, by, "inner", null_safe=True).filter("row_number is null or row_number <= _last").drop("_last")
    first = mapped_values(near.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n), contract.field_names)
    values = []
    for name in contract.field_names:
        value = F.col(name)
        if name == "sales_date":
            serial = value.rlike(r"^[0-9]+(\.[0-9]+)?$")
            value = F.when(serial, clean_excel_date(F.when(serial, value)).cast("string")).otherwise(value)
        values.append(F.coalesce(value, F.lit("")).alias(name))
    return first.select(*by, F.col("row_number").cast("string").alias("source_row_number"), *values)
