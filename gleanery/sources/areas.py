"""The area tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import area_tree
from ..session import shared_dir


def _node(x: Column) -> Column:
    return F.struct(x["id"].alias("id"), x["parent_id"].alias("parent_id"), x["name"].alias("name"))


def flatten_area_tree(df: DataFrame, areas: str = "areas", depth: int = 5) -> DataFrame:
    """Nodes ``(id, parent_id, name)`` of nested ``areas`` arrays, at any depth.

    Read the tree with ``schemas.area_tree(depth)``: that many levels are taken in one pass, and the
    children of the last, which are raw text, are parsed and taken in further passes while there are
    any. An empty tree fails at once.
    """
    shared_dir(df.sparkSession)
    found = None
    trees = df.select(F.col(areas).alias("areas"))
    while True:
        level, nodes = F.col("areas"), []
        for _ in range(depth):
            nodes.append(F.transform(level, _node))
            level = F.flatten(F.transform(level, lambda x: F.coalesce(x["areas"], F.array())))
        flat = trees.select(F.inline(F.concat(*nodes)))
        found = flat if found is None else found.unionByName(flat)
        below = trees.select(F.explode(level).alias("text")).checkpoint()
        if below.isEmpty():
            break
        parsed = F.from_json("text", area_tree(depth)[len("ARRAY<") : -1], {"mode": "FAILFAST"})
        trees = below.select(F.array(parsed).alias("areas"))
    if found.isEmpty():
        raise ValueError("the area tree has no nodes")
    return found
