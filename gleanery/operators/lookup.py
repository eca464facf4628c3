"""Equi joins with dictionaries and other small or keyed sides.

No side is broadcast by hint: Spark broadcasts one whose size it knows to be below its
threshold, and splits skewed partitions of the other joins at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shape import live
from .skew import spread


def lookup(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    dict_key: str,
    values: dict[str, str],
    strict: bool = False,
    of: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add dictionary columns (``{dictionary column: new column}``) by key.

    ``dictionary`` holds one row per key. Returns the rows (NULL where the key is missing) and
    the rejects: each non-NULL key not in the dictionary with its number of rows. With
    ``strict`` a missing key fails the query instead. ``of`` is an earlier state of the same rows
    that has the key: the rejects are counted there, without the look-ups in between.
    """
    columns = dictionary.select(
        F.col(dict_key).alias("_key"), *[F.col(c).alias(new) for c, new in values.items()]
    )
    entries = spread(columns, "_key").withColumn("_found", F.lit(True))
    joined = df.join(entries, F.col(key) == F.col("_key"), "left")
    if strict:
        missing = F.col(key).isNotNull() & F.col("_found").isNull()
        message = F.concat(F.lit(f"{key} not in the dictionary: "), F.col(key).cast("string"))
        # Every row passes the check, and the check is in the filter, which pruning cannot drop.
        joined = joined.where(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(True))
    rejects = (
        (df if of is None else of).where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(entries, F.col("key") == F.col("_key"), "left_anti")
    )
    return joined.drop("_key", "_found"), rejects


def judged_lookup(df: DataFrame, dictionary: DataFrame, key: str, dict_key: str, values: dict[str, str], name: str) -> DataFrame:
    """As ``lookup``, with the verdict in the rows: ``name`` is appended to ``lacking`` where the key is not in the dictionary.

    Nothing is computed twice: the rejects are those rows (``rejects_of``), once the rows are written.
    """
    columns = dictionary.select(F.col(dict_key).alias("_key"), *[F.col(c).alias(new) for c, new in values.items()])
    joined = df.join(spread(columns, "_key").withColumn("_found", F.lit(True)), F.col(key) == F.col("_key"), "left")
    earlier = F.col("lacking") if "lacking" in df.columns else F.array().cast("array<string>")
    missing = F.col(key).isNotNull() & F.col("_found").isNull()
    lacking = F.when(missing, F.array_append(earlier, F.lit(name))).otherwise(earlier)
    return joined.withColumn("lacking", lacking).drop("_key", "_found")


def rejects_of(judged: DataFrame, name: str, key: str) -> DataFrame:
    """Each key that the dictionary ``name`` lacked, with its number of rows."""
    lacked = judged.where(F.array_contains("lacking", name))
    return lacked.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def org_list(bridge: DataFrame, orgs: DataFrame) -> DataFrame:
    """Live organisations registered with the search service."""
    registered = live(bridge).select(
        F.col("id").alias("rosrid_university_id"), "university_id", "rosrid_id"
    )
    known = live(orgs).select(F.col("id").alias("university_id"), "ogrn")
    return registered.join(known, "university_id")


def with_children(df: DataFrame, *aggregates: DataFrame, on: str) -> DataFrame:
    """Inner join with per-parent aggregates: a parent that lacks one of them drops out."""
    return reduce(lambda left, right: left.join(right, on), aggregates, df)


def with_fetch(entries: DataFrame, manifest: DataFrame, on: tuple[str, ...] = ("url",), interval: str | None = None) -> DataFrame:
    """Attach the stored key of each article; NULL unless it was fetched with status 200.

    ``interval`` names the run whose fetches count; without it the manifest must be of one run. A run
    that was tried again leaves the smallest key.
    """
    mine = manifest if interval is None else manifest.where(F.col("interval") == interval)
    fetched = mine.where("status = 200").groupBy(*on).agg(F.min("s3_key").alias("s3_key"))
    return entries.join(spread(fetched, on[0]), list(on), "left")
