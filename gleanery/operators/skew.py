"""Joins of rows that may be skewed with a side that has one row per key.

Spark splits a hot partition only if both sides of the join come straight out of the join's own
shuffle. A side that was grouped, ranked or joined by the key before is already distributed by
it, so the join adds no shuffle there and nothing is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *key: str) -> DataFrame:
    """``df``, with one row per key (of one or more columns), distributed in a way no join by the key can reuse.

    The price is one more shuffle of the side with one row per key; it buys that the other side,
    however skewed, can be split.
    """
    return df.withColumn("_spread", F.xxhash64(*key)).repartition("_spread").drop("_spread")


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, whose next join shuffles both sides, however small Spark takes one of them to be.

    For sides whose size Spark cannot know: it counts exploded rows as if there was one for each array, and rows of
    a compressed file by the file's bytes. Broadcast, such a side may not fit the driver. Hot partitions are still split.
    """
    return df.hint("merge")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Each key once, combined map-side, ready for a join by the key."""
    return spread(df.select(key).distinct(), key)
