"""Date windows: trailing days from a global latest date, latest date per group."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from ..sources import commits
from .joins import lookup_join


def latest_date(df: DataFrame, date_col: str) -> dt.date | None:
    """Global latest date. Every task sends one value, so this is a cheap single-column pass."""
    return df.agg(F.max(date_col).alias("latest")).first()["latest"]


def window_start(latest: dt.date, days: int = 30) -> dt.date:
    return latest - dt.timedelta(days=days)


def trailing_days(df: DataFrame, date_col: str, latest: dt.date | None, days: int = 30) -> DataFrame:
    """Rows of the ``days`` calendar days that end with ``latest``, inclusive.

    The bound is a literal, so it is pushed through joins and aggregates to the
    scan. A stored fact also has the month of the date: the months that the bound
    leaves follow from it and choose folders before any file is opened.
    """
    if latest is None:
        return df.limit(0)
    start = window_start(latest, days)
    return commits.from_month(df.filter(F.col(date_col) > F.lit(start)), f"{start + dt.timedelta(days=1):%Y-%m}")


def latest_date_by(df: DataFrame, group: str, date_col: str) -> DataFrame:
    """Latest non-blank date per group; NULL for a group that has no date at all."""
    dated = F.when(F.col(date_col) != "", F.col(date_col))
    return df.groupBy(group).agg(F.max(dated).alias(date_col))


def latest_per_group(df: DataFrame, group: str, date_col: str) -> DataFrame:
    """Keep the rows at their group's latest date.

    A group without any date keeps its undated rows: NULL equals NULL here.
    """
    latest = materialise(latest_date_by(df, group, date_col))
    return lookup_join(df, latest, [group, date_col], how="inner", null_safe=True)
