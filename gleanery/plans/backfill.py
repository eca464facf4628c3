"""Runs over many past intervals."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lag_window


def monthly_intervals(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Monthly interval ends from ``first`` to ``last`` with the reporting window of each."""
    ends = F.sequence(
        F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"), F.expr("interval 1 month")
    )
    return with_windows(spark.range(1).select(F.explode(ends).alias("interval_end")), F.col("interval_end"))


def with_windows(df: DataFrame, interval_end: Column, months: int = 3) -> DataFrame:
    start, end = lag_window(interval_end, months)
    return df.withColumns({"start_date": start, "end_date": end})


def run_intervals(
    spark: SparkSession, first: str, last: str, run: Callable[[datetime], int]
) -> dict[datetime, int]:
    """Run a load once per interval, one after the other, oldest first.

    Only the interval ends come to the driver. Each load builds on the table the one before
    left, so they cannot overlap; the transforms of all intervals can share one job, see
    ``with_windows``. Keyed loads of many intervals need no loop, see ``actives.load_actives_history``.
    """
    ends = monthly_intervals(spark, first, last).orderBy("interval_end").collect()
    return {row.interval_end: run(row.interval_end) for row in ends}
