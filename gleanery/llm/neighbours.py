"""Nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import spread
from .common import written
from .vectors import matrix, norm, sizes_of, usable

TREES = 16
#: Vectors that the trees' planes are fitted on, at most, the first by a hash of their ids.
SAMPLE = 20_000
#: Rows in a leaf, about, while the sample has enough rows for that many leaves.
LEAF_ROWS = 100
LEAST_SAMPLE_IN_LEAF = 8
#: Rows of leaves that a query looks at, at least, rows in several trees counted for each.
EXAMINED = 36_000
#: Share of true neighbours that queries must find, and how many queries show it, at most, the first by a hash of their ids.
RECALL, MEASURED = 0.9, 256
#: Standard errors by which the measured queries must be above ``RECALL``.
SURE = 3.0
#: Candidates of a task that are gathered before all but each query's best are dropped.
GATHERED = 300_000
ROUNDING = 1e-9
#: Queries whose distances to all planes are held at once.
AT_ONCE = 16
SEED = 7


@dataclass
class Tree:
    """A full binary tree: node i has children 2i+1 and 2i+2; leaves are numbered from 0."""

    normals: np.ndarray
    offsets: np.ndarray

    @property
    def inner(self) -> int:
        return len(self.offsets)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(x) and node[0] < self.inner:
            beyond = np.einsum("ij,ij->i", x, self.normals[node]) > self.offsets[node]
            node = 2 * node + 1 + beyond
        return node - self.inner


def plant(sample: np.ndarray, depth: int, seed: int) -> Tree:
    """Every node parts its rows in halves along the line through two of them."""
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    normals, offsets = np.zeros((inner, sample.shape[1]), np.float32), np.zeros(inner, np.float32)
    held = {0: np.arange(len(sample))}
    for node in range(inner):
        rows = held.pop(node)
        line = rng.standard_normal(sample.shape[1])
        if len(rows) > 1:
            a, b = rng.choice(rows, 2, replace=False)
            if (sample[a] != sample[b]).any():
                line = sample[a] - sample[b]
        normals[node] = line / np.linalg.norm(line)
        along = sample[rows] @ normals[node]
        offsets[node] = np.median(along) if len(rows) else 0
        held[2 * node + 1], held[2 * node + 2] = rows[along <= offsets[node]], rows[along > offsets[node]]
    return Tree(normals, offsets)


def search(trees: list[Tree], queries: np.ndarray, sizes: list[np.ndarray], examined: int) -> Iterator[list[tuple[int, int]]]:
    """For each query the leaves ``(tree, leaf)`` to look at, by one priority queue over all trees.

    The queue holds the sides not taken, by the largest distance to a plane on the way there. The next
    side is followed to its leaf, until the leaves hold ``examined`` rows.
    """
    inner = trees[0].inner
    planes = np.concatenate([t.normals for t in trees])
    offsets = np.concatenate([t.offsets for t in trees])
    for start in range(0, len(queries), AT_ONCE):
        for distances in (queries[start : start + AT_ONCE] @ planes.T - offsets).tolist():
            queue = [(0.0, tree, 0) for tree in range(len(trees))]
            found, seen = [], 0
            while queue and seen < examined:
                far, tree, node = heapq.heappop(queue)
                while node < inner:
                    distance = distances[tree * inner + node]
                    near = 2 * node + 1 + (distance > 0)
                    other = 4 * node + 3 - near
                    heapq.heappush(queue, (max(far, abs(distance)), tree, other))
                    node = near
                leaf = node - inner
                if sizes[tree][leaf]:
                    found.append((tree, leaf))
                    seen += sizes[tree][leaf]
            yield found


def reached(trees: list[Tree], queries: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """For each query the ``examined`` with which ``search`` looks at each leaf, whatever the order of equal distances."""
    planes = np.concatenate([t.normals for t in trees])
    offsets = np.concatenate([t.offsets for t in trees])
    held = sizes.ravel()
    for query in queries:
        distances = (planes @ query - offsets).reshape(len(trees), -1)
        far, level = np.zeros((len(trees), 1)), 0
        while far.shape[1] < sizes.shape[1]:
            distance = distances[:, level : 2 * level + 1]
            beyond, farther = distance > 0, np.maximum(far, np.abs(distance))
            far = np.stack([np.where(beyond, farther, far), np.where(beyond, far, farther)], axis=2).reshape(len(trees), -1)
            level = 2 * level + 1
        far = far.ravel()
        order = np.argsort(far)
        upto = np.cumsum(held[order])[np.searchsorted(far[order], far, side="right") - 1]
        yield upto - held + 1


def enough(query: np.ndarray, needed: np.ndarray) -> int:
    """The least ``examined`` with which queries surely find ``RECALL`` of their neighbours, given what each neighbour needs."""
    _, query, counts = np.unique(query, return_inverse=True, return_counts=True)
    for examined in np.unique(np.quantile(needed, np.linspace(RECALL, 1, 101), method="higher")):
        found = np.bincount(query, needed <= examined) / counts
        if found.mean() - SURE * found.std() / np.sqrt(len(found)) >= RECALL:
            break
    return int(examined)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components, so that a pair has one score everywhere."""
    return np.add.accumulate(a * b, axis=1)[:, -1]


def best(query: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` best, largest score first, then smallest id, each id once."""
    order = np.lexsort((other, -score, query))
    q, o = query[order], other[order]
    again = np.concatenate([[False], (q[1:] == q[:-1]) & (o[1:] == o[:-1])])[: len(q)]
    order, q = order[~again], q[~again]
    starts = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1]) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(q)]])))
    return order[rank < k]


class _Best:
    """Each query's best candidates so far; most new ones are below its k-th best and are dropped at once."""

    def __init__(self, k: int):
        self.k, self.parts, self.rows = k, [], 0
        self.queries, self.floors = np.zeros(0, np.int64), np.zeros(0)

    def add(self, query: np.ndarray, queries: np.ndarray, other: np.ndarray, rows: np.ndarray) -> None:
        """All queries of a leaf and some of its rows, ids and vectors."""
        scores = queries @ rows.T
        floor = np.full(len(query), -np.inf)
        if len(self.queries):
            at = np.minimum(np.searchsorted(self.queries, query), len(self.queries) - 1)
            floor = np.where(self.queries[at] == query, self.floors[at], floor)
        if scores.shape[1] > self.k:
            # A query's own row is among the candidates, so one more than k counts here.
            kth = -np.partition(-scores, self.k, axis=1)[:, self.k]
            floor = np.maximum(floor, kth)
        # The product of matrices rounds differently from leaf to leaf; the score that counts is computed by pairs.
        floor = floor - ROUNDING * (1 + np.abs(scores).max(axis=1))
        i, j = np.nonzero((scores >= floor[:, None]) & (query[:, None] != other[None, :]))
        self.parts.append((query[i], other[j], inner(queries[i], rows[j])))
        self.rows += len(i)

    def compact(self) -> tuple[np.ndarray, ...]:
        joined = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        kept = [c[rows] for rows in [best(*joined, self.k)] for c in joined]
        self.parts, self.rows = [tuple(kept)], len(kept[0])
        self.queries, starts, counts = np.unique(kept[0], return_index=True, return_counts=True)
        self.floors = np.where(counts == self.k, kept[2][starts + counts - 1], -np.inf)
        return tuple(kept)


    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in self.compact()], ["query_id", "vec_id", "score"])


def _depth(rows: int, sampled: int) -> int:
    return max(0, min(rows // LEAF_ROWS, sampled // LEAST_SAMPLE_IN_LEAF).bit_length())


def nearest(
    rows: DataFrame,
    is_query: str,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    examined: int | None = None,
) -> DataFrame:
    """For each row for which ``is_query`` holds its ``k`` nearest: ``query_id, rank, vec_id, score``.

    Nearness is the inner product in double precision, larger first, then the smaller id. The trees'
    planes come from a bounded sample; every row is in the index. Inner products become distances by one
    more component, which makes all rows equally long. Queries meet the rows of their leaves only, and
    those are scored exactly. A query that may examine all rows gets its true neighbours.

    Unless ``examined`` says how many rows of leaves a query looks at, a bounded number of queries is compared
    with all rows, and all queries look at as many as these need for ``RECALL``, and at ``EXAMINED`` at least.

    Vectors of each size have a forest of their own, which queries of that size meet. Rows without id and
    unusable vectors take no part. Of equal vectors the ``k + 1`` smallest ids are indexed, which no others can come before. Repeated rows count once.
    """
    given = rows.select(F.col(id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    given = given.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    given = written(given.distinct(), "vectors")
    queries = rows.where(is_query).select(F.col(id).cast("bigint").alias("vec_id")).distinct()
    sizes = sizes_of(given, "vector") or [0]
    scored = [_scored(given.where(F.size("vector") == size), queries, size, k, trees, examined) for size in sizes]
    return _ranked(reduce(DataFrame.unionByName, scored), k).select("query_id", "rank", "vec_id", "score")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)


def _scored(given: DataFrame, queries: DataFrame, size: int, k: int, trees: int, examined: int | None) -> DataFrame:
    """``query_id, vec_id, score`` of each task's best candidates, for vectors of one size."""
    longest, count = given.agg(F.max(norm(F.col("vector"))), F.count(F.lit(1))).first()
    longest = longest or 1.0
    order = Window.partitionBy("vector").orderBy("vec_id")
    indexed = given.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")

    def lengthened(x: np.ndarray, is_row: bool) -> np.ndarray:
        x = x.astype(np.float64) / longest
        last = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1))) if is_row else np.zeros(len(x))
        if not is_row:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.column_stack([x, last]).astype(np.float32)

    sample = indexed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    points = lengthened(matrix(sample["vector"].combine_chunks(), size), True) if size else np.zeros((0, 1), np.float32)
    depth = _depth(count, len(points))
    forest = [plant(points, depth, SEED + i) for i in range(trees)]
    session = given.sparkSession
    shared = session.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = lengthened(matrix(batch.column("vector"), size), True)
            for number, tree in enumerate(shared.value):
                leaf = number * (tree.inner + 1) + tree.leaves(x)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("vec_id"), batch.column("vector")], ["leaf", "vec_id", "vector"])

    schema = f"leaf bigint, vec_id bigint, vector {given.schema['vector'].dataType.simpleString()}"
    leaves = written(indexed.mapInArrow(place, schema), "leaves")
    # A number for each leaf: as many as the sample allows, whatever the table's size.
    counted = np.zeros(trees << depth, np.int64)
    for leaf, n in leaves.groupBy("leaf").count().collect():
        counted[leaf] = n
    sizes = session.sparkContext.broadcast(counted.reshape(trees, -1))
    asked = given.join(spread(queries, "vec_id"), "vec_id", "left_semi")

    def measured() -> int:
        some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MEASURED).toArrow().combine_chunks()
        if not len(some):
            return EXAMINED
        ids, first = np.unique(some["vec_id"].to_numpy(), return_index=True)
        vectors = matrix(some["vector"].combine_chunks(), size)[first]

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = _Best(k)
            for batch in batches:
                if batch.num_rows:
                    top.add(ids, vectors.astype(np.float64), batch.column("vec_id").to_numpy(), matrix(batch.column("vector"), size).astype(np.float64))
                if top.rows > GATHERED:
                    top.compact()
            yield top.batch()

        # The first tree's leaves have every row of the index once.
        once = leaves.where(F.col("leaf") < counted.size // trees)
        true = _ranked(once.mapInArrow(compare, "query_id bigint, vec_id bigint, score double"), k).select("query_id", "vec_id")
        places = leaves.select("leaf", "vec_id").join(F.broadcast(true), "vec_id").toArrow()
        if not len(places):
            return EXAMINED
        query, other, leaf = (places[c].to_numpy() for c in ("query_id", "vec_id", "leaf"))
        needs = np.zeros(len(leaf), np.int64)
        for one, reach in zip(ids, reached(forest, lengthened(vectors, False), sizes.value)):
            needs[query == one] = reach[leaf[query == one]]
        # A neighbour is found in whichever tree comes to it first.
        order = np.lexsort((needs, other, query))
        pairs, first = np.unique(np.column_stack([query, other])[order], axis=0, return_index=True)
        return max(EXAMINED, enough(pairs[:, 0], needs[order][first]))

    if examined is None:
        examined = EXAMINED if count * trees <= EXAMINED else measured()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = lengthened(matrix(batch.column("vector"), size), False)
            for at in range(0, len(x), 32):
                found = list(search(shared.value, x[at : at + 32], list(sizes.value), examined))
                row = np.repeat(np.arange(at, at + len(found)), [len(f) for f in found])
                leaf = np.array([tree * sizes.value.shape[1] + leaf for f in found for tree, leaf in f], np.int64)
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), part.column("vec_id"), part.column("vector")], ["leaf", "vec_id", "vector"])

    # Few rows, each of which looks at many leaves.
    tasks = max(2, int(session.conf.get("spark.sql.shuffle.partitions")))
    looked = asked.repartition(tasks, "vec_id").mapInArrow(look, schema)
    both = leaves.withColumn("asks", F.lit(1)).unionByName(looked.withColumn("asks", F.lit(0)))
    both = both.repartition(tasks, "leaf").sortWithinPartitions("leaf", "asks", "vec_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, at, ids, vectors = _Best(k), -1, [], []
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            asks, vec_id = batch.column("asks").to_numpy(), batch.column("vec_id").to_numpy()
            x = matrix(batch.column("vector"), size).astype(np.float64)
            ends = np.concatenate([np.flatnonzero(leaf[1:] != leaf[:-1]) + 1, [len(leaf)]]) if len(leaf) else []
            start = 0
            for end in ends:
                if leaf[start] != at:
                    at, ids, vectors = leaf[start], [], []
                # A leaf's queries come first; its rows follow, over as many batches as they take.
                split = start + int((asks[start:end] == 0).sum())
                if split > start:
                    ids.append(vec_id[start:split])
                    vectors.append(x[start:split])
                if ids and split < end:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    for few in range(0, len(ids[0]), 1024):
                        some = slice(few, few + 1024)
                        top.add(ids[0][some], vectors[0][some], vec_id[split:end], x[split:end])
                start = end
                if top.rows > GATHERED:
                    top.compact()
                    if top.rows > GATHERED // 2:  # very many queries: their best so far go out
                        yield top.batch()
                        top = _Best(k)
        yield top.batch()

    # About k candidates of a query come from each task.
    return both.mapInArrow(score, "query_id bigint, vec_id bigint, score double")
