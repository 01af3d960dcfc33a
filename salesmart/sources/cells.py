"""Sheet rows from landed cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join


def column_index(cell_ref: Column) -> Column:
    """Zero-based column of a cell reference: ``A1`` -> 0, ``AA7`` -> 26."""
    letters = F.upper(F.regexp_extract(cell_ref, "^([A-Za-z]+)", 1))
    places = F.filter(F.split(letters, ""), lambda c: c != "")
    return F.aggregate(places, F.lit(0), lambda acc, c: acc * 26 + F.ascii(c) - 64) - 1


def rows_from_cells(cells: DataFrame, shared_strings: DataFrame) -> DataFrame:
    """Cells -> one row per sheet row with ``cells``, a map of column index to text.

    A cell of type ``s`` holds a position in its workbook's shared strings, and
    one that points to no string fails the job; other cells hold their text and
    take no part in the lookup. One string may be used by very many cells, so
    the lookup splits such keys. A row has at most as many cells as a sheet has
    columns.
    """
    place = ["workbook_identifier", "sheet_name", "sheet_index", "row_number"]
    by_string = F.coalesce(F.col("cell_type") == "s", F.lit(False))
    pointed = cells.filter(by_string).withColumn("string_index", F.col("value").cast("int"))
    texts = shared_strings.select(
        "workbook_identifier", "string_index", F.col("text").alias("shared_text"), F.lit(True).alias("_found")
    )
    shared = lookup_join(pointed, texts, ["workbook_identifier", "string_index"], "left")
    dangling = F.raise_error(F.concat(F.lit("Cell points to no shared string: "), F.coalesce("cell_ref", F.lit("?"))))
    looked_up = F.when(F.col("_found"), F.col("shared_text")).otherwise(dangling.cast("string"))
    ref = column_index(F.col("cell_ref")).alias("key")
    entries = shared.select(*place, F.struct(ref, looked_up.alias("value")).alias("entry")).unionByName(
        cells.filter(~by_string).select(*place, F.struct(ref, F.coalesce("value", F.lit("")).alias("value")).alias("entry"))
    )
    return entries.groupBy(*place).agg(F.map_from_entries(F.collect_list("entry")).alias("cells"))


def dense_cells(cells: Column) -> Column:
    """Cell map -> array from column 0 to the last used column, gaps as empty text."""
    last = F.array_max(F.map_keys(cells))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(F.try_element_at(cells, i), F.lit("")))
