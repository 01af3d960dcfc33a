"""Spreadsheet dates and month buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

# Serial day zero, last serial day (9999-12-31), text forms accepted.
SERIAL_ZERO = dt.date(1899, 12, 30)
LAST_SERIAL = 2958465
SERIAL_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
TEXT_FORMATS = ("yyyy-M-d", "yyyy/M/d", "yyyy-MM-dd HH:mm:ss")


def _serial_day(text: Column) -> Column:
    serial = F.floor(text.try_cast("decimal(38,10)"))
    return F.date_add(F.lit(SERIAL_ZERO), F.when(serial <= LAST_SERIAL, serial).cast("int"))


def excel_date(c: Column) -> Column:
    """Serial-number or text date. Blank is NULL; anything unreadable fails the job."""
    return clean_excel_date(blank_to_null(c))


def clean_excel_date(text: Column) -> Column:
    """``excel_date`` of text that is already trimmed, with blank as NULL."""
    parsed = F.when(text.rlike(SERIAL_PATTERN), _serial_day(text)).otherwise(
        F.coalesce(*[F.try_to_date(text, f) for f in TEXT_FORMATS])
    )
    problem = F.raise_error(F.concat(F.lit("Not a date: "), text)).cast("date")
    return F.when(text.isNull(), F.lit(None).cast("date")).otherwise(F.coalesce(parsed, problem))


def normalise_date_text(text: Column) -> Column:
    """Serial numbers become ISO text; every other (trimmed) text is kept as it is."""
    problem = F.raise_error(F.concat(F.lit("Serial date out of range: "), text)).cast("string")
    return F.when(text.rlike(SERIAL_PATTERN), F.coalesce(_serial_day(text).cast("string"), problem)).otherwise(text)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM").cast("date")


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")
