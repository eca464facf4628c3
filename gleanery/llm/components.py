"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import shuffled, spread
from .common import written


#: More edges than these are not broadcast, however small their compressed file is.
SENT = 100_000


def _digest(edges: DataFrame) -> tuple:
    # Unordered pairs as they are; the sum wraps around, which is fine for a comparison.
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.min("u"), F.max("u")).first())


def _with_least(edges: DataFrame, many: bool) -> DataFrame:
    """Each edge ``(u, v)`` with the least neighbour of ``u``; a node with very many edges is split."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return (shuffled(edges) if many else edges).join(spread(least, "u"), "u")


def components(links: DataFrame) -> DataFrame:
    """``links (a, b)`` of whole numbers to ``node, root``: root is the least node reachable.

    Nodes without a link to another node do not occur. NULL ends and links of a node to itself count
    for nothing; repeated links count once. Every step only joins and groups; nothing of the graph
    passes through the driver but a checksum. Each step at least halves long paths, so the number of
    steps grows with the logarithm of the longest one.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = written(links.where("a <> b").select(larger, smaller).distinct(), "links")
    before = _digest(edges)
    while before[0]:
        many = before[0] > SENT
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star = _with_least(both, many).where("v > u")
        large = star.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        star = _with_least(large, many)
        hung = star.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = hung.unionByName(star.select("u", F.col("least").alias("v"))).distinct()
        edges = written(small, "links")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
