"""Text cleaning and JSON text, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def payload_text(payload: Column, *headers: str) -> Column:
    """First non-blank value among the listed headers of one row's payload map."""
    return F.coalesce(*[blank_to_null(F.try_element_at(payload, F.lit(h))) for h in headers])


def key_text(c: Column) -> Column:
    """Identity part for a fact key: never NULL."""
    return F.coalesce(c, F.lit(""))


def key_display(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def display_name(name: Column, code: Column) -> Column:
    return F.coalesce(name, code)


def json_text_map(text: Column) -> Column:
    """JSON object text -> map of header to text value."""
    return F.from_json(text, "map<string,string>")


def _json_string(c: Column) -> Column:
    """JSON literal of one text; the general escape runs only where a character needs it."""
    escaped = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    return F.when(c.rlike(r'["\\\x00-\x1f]'), escaped).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def json_object_text(values: Column) -> Column:
    """Map of text to text -> JSON object with sorted keys, ``", "`` and ``": "`` separators."""
    parts = F.transform(
        F.sort_array(F.map_entries(values)),
        lambda e: F.concat(_json_string(e["key"]), F.lit(": "), _json_string(e["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))
