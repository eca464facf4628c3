"""Reporting periods. ``now`` and intervals are arguments, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lag_window(day: Column, months: int = 3) -> tuple[Column, Column]:
    """First and last day of the month ``months`` before ``day``."""
    month = F.add_months(day.cast("date"), -months)
    return F.trunc(month, "month"), F.last_day(month)


def month_before(now) -> Column:
    """The same day a month earlier; the day is clamped to the length of that month."""
    # As text, so that neither Python's nor the session's zone can move the day.
    return F.add_months(F.lit(str(now)[:10]).cast("date"), -1)


def trailing_month(df: DataFrame, col: str, now) -> DataFrame:
    """Rows since a month before ``now``. The bound folds to a literal and reaches the scan."""
    return df.where(F.col(col) >= month_before(now))


def latest_period(
    df: DataFrame, col: str, of: DataFrame | None = None, from_month_start: bool = False
) -> DataFrame:
    """Rows on the last date that ``of`` (default ``df``) holds, or in that date's whole month.

    The bound is a scalar subquery: one small aggregate whose result the scan can filter on.
    """
    newest = (df if of is None else of).agg(F.max(col).cast("date")).scalar()
    lower = F.trunc(newest, "month") if from_month_start else newest
    return df.where((F.col(col) >= lower) & (F.col(col) <= F.last_day(newest)))
