"""Climbing a parent-id hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .skew import spread


def climb_to_top(nodes: DataFrame, root_name: str) -> DataFrame:
    """For each node of ``(id, parent_id, name)`` the name of its ancestor just below the root.

    Returns ``id, top_name``: NULL for a root and for nodes whose root has another name. Each step
    doubles the distance climbed, so a path of any length takes a number of equi joins that is the
    logarithm of its length; the dictionary may be of any size, and facts are joined to the result
    by id. A cycle fails, as does a parent that is not in the dictionary.
    """
    shared_dir(nodes.sparkSession)
    known = nodes.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
    parents = nodes.join(spread(known, "_id"), F.col("parent_id") == F.col("_id"), "left")
    lost = F.raise_error(F.concat(F.lit("no node with id "), F.col("parent_id").cast("string")))
    at = F.when(F.col("parent_id").isNull(), F.col("id")).when(F.col("_id").isNull(), lost.cast("string")).otherwise(F.col("_id"))
    # (at, below): the node reached, and the name of the one just below it on the way.
    climbing = parents.select(
        "id",
        at.cast(nodes.schema["id"].dataType).alias("at"),
        F.when(F.col("parent_id").isNotNull(), F.col("name")).alias("below"),
        F.col("parent_id").isNull().alias("is_root"),
    ).checkpoint()
    steps = climbing.count().bit_length() + 1
    while climbing.where("NOT is_root").join(climbing.where("is_root").select(F.col("id").alias("at")), "at", "left_anti").limit(1).count():
        if not steps:
            raise ValueError("the hierarchy has a cycle")
        steps -= 1
        reached = climbing.select(F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("below").alias("_below"))
        moved = climbing.join(spread(reached, "_id"), F.col("at") == F.col("_id"))
        climbing = moved.select("id", F.col("_at").alias("at"), F.coalesce("_below", "below").alias("below"), "is_root").checkpoint()
    top = climbing.join(spread(known, "_id"), F.col("at") == F.col("_id"))
    return top.select("id", F.when(F.col("_name") == root_name, F.col("below")).alias("top_name"))


def paths_to_top(nodes: DataFrame) -> DataFrame:
    """For each node of ``(id, parent_id, name)`` the names from its root down to itself.

    Returns ``id, path, depth``, the depth of a root being 1. Each step joins a node's list with that of the
    node it has reached, so lists double: as many equi joins as the logarithm of the longest path. A cycle
    fails, as does a parent that is not in the dictionary. The result is as large as all paths together.
    """
    shared_dir(nodes.sparkSession)
    known = nodes.select(F.col("id").alias("_id"))
    parents = nodes.join(spread(known, "_id"), F.col("parent_id") == F.col("_id"), "left")
    lost = F.raise_error(F.concat(F.lit("no node with id "), F.col("parent_id").cast("string"))).cast(nodes.schema["id"].dataType)
    # (path, above): the names so far, and the node above the first of them; NULL when the path is whole.
    above = F.when(F.col("parent_id").isNotNull() & F.col("_id").isNull(), lost).otherwise(F.col("_id"))
    climbing = parents.select("id", F.array("name").alias("path"), above.alias("above")).checkpoint()
    steps = climbing.count().bit_length() + 1
    while climbing.where("above IS NOT NULL").limit(1).count():
        if not steps:
            raise ValueError("the hierarchy has a cycle")
        steps -= 1
        reached = climbing.select(F.col("id").alias("_id"), F.col("path").alias("_path"), F.col("above").alias("_above"))
        moved = climbing.where("above IS NOT NULL").join(spread(reached, "_id"), F.col("above") == F.col("_id"))
        moved = moved.select("id", F.concat("_path", "path").alias("path"), F.col("_above").alias("above"))
        climbing = climbing.where("above IS NULL").unionByName(moved).checkpoint()
    return climbing.select("id", "path", F.size("path").alias("depth"))
