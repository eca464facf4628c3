"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """First row per key in the given order, which must be total for a repeatable result.

    The rank filter lets Spark keep one row per key and map task before the shuffle, so a key
    that holds most rows still reaches its reducer as a few rows only.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_document(df: DataFrame, key: str, *fetch_order: str) -> DataFrame:
    """Last written document per key."""
    return latest_per_key(df, [key], *[F.col(c).desc() for c in fetch_order])
