"""Near-duplicate embeddings by binary codes of randomly rotated vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import spread
from .common import written
from .components import components
from .vectors import matrix, sizes_of, usable

SEED = 11
#: How often a pair just at the threshold may share no bucket at all.
MISSED = 0.0005
#: Rows that a bucket has on average if vectors lie evenly.
BUCKET_ROWS = 8
#: Rows of a bucket that meet at once; a larger bucket is compared block by block, in many tasks.
BLOCK = 2048
#: Rows of a block that meet all others in one step.
STRIP = 256
#: Half width of the confidence bounds, in standard deviations of the estimate.
BOUND = 4.0
#: Runs of this many rows or fewer are compared as single pairs, together with their neighbours.
SHORT = 24
PAIRS = 1 << 14


def rotations(size: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Random orthonormal bases below each other, at least ``bits`` rows."""
    rng = np.random.default_rng(seed)
    made = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-bits // size))]
    return np.concatenate(made)


def layout(rows: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket's key and number of tables, so that few pairs at the threshold share no bucket.

    A bit of two vectors differs as often as their angle is to a half turn. More rows take longer keys,
    and longer keys more tables.
    """
    bits = max(4, min(30, round(math.log2(max(1, rows / BUCKET_ROWS)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


class Codes:
    """Codes, correction factors and estimates for unit vectors.

    The code of a vector is the signs of its rotated components, that is the nearest corner of a cube. The
    factor is the inner product of the vector with its corner (of length one). For another vector q, the
    inner product of q with the corner divided by the factor is an unbiased estimate of that with the vector;
    its error is at most about sqrt((1 - factor^2) / (factor^2 (n - 1))) in standard deviations.
    """

    def __init__(self, size: int, bits: int, seed: int = SEED):
        self.basis = rotations(size, bits, seed)
        self.n = len(self.basis)

    def rotated(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors in all bases, scaled so that they are unit vectors again."""
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return unit @ self.basis.T / math.sqrt(self.n / len(self.basis[0]))

    def packed(self, rotated: np.ndarray) -> pa.Array:
        """Codes to be stored, eight signs a byte."""
        return pa.array([row.tobytes() for row in np.packbits(rotated >= 0, axis=1)], pa.binary())

    def corners(self, codes: pa.Array) -> np.ndarray:
        """The corners that stored codes stand for."""
        signs = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1)
        return (np.unpackbits(signs, axis=1, count=self.n) * 2.0 - 1) / math.sqrt(self.n)

    def factor(self, rotated: np.ndarray) -> np.ndarray:
        return np.abs(rotated).sum(axis=1) / math.sqrt(self.n)

    def width(self, factor: np.ndarray) -> np.ndarray:
        return BOUND * np.sqrt(np.maximum(0, 1 - factor**2) / (factor**2 * max(1, self.n - 1)))


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In double precision, from the vectors as given, row by row."""
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions the least one that links ``i, j`` connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pairs(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside consecutive runs of the given lengths, as positions i < j."""
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    stops = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(lengths.sum())
    more = stops - at - 1
    i = np.repeat(at, more)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more)
    return i, j


class Comparison:
    """Links among the rows of one bucket, or of two blocks of one."""

    def __init__(self, codes: Codes, threshold: float):
        self.codes, self.threshold = codes, threshold

    def exact(self, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The links among the pairs that their bounds leave open."""
        for at in range(0, len(i), PAIRS):
            a, b = i[at : at + PAIRS], j[at : at + PAIRS]
            links = _cosine(x[a], x[b]) >= self.threshold
            yield a[links], b[links]

    def of_runs(self, x: np.ndarray, corners: np.ndarray, factor: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links ``i < j`` between the rows of each run of consecutive rows, some at a time.

        ``corners`` and ``factor`` are what the rows' codes tell: bounds come from those of ``i``, and vectors
        are multiplied only if the upper bound reaches the threshold.
        """
        rotated, width = self.codes.rotated(x), self.codes.width(factor)
        short, starts = lengths <= SHORT, np.cumsum(lengths) - lengths
        rows = np.flatnonzero(np.repeat(short, lengths))
        i, j = _pairs(lengths[short])
        for at in range(0, len(i), PAIRS):
            a, b = rows[i[at : at + PAIRS]], rows[j[at : at + PAIRS]]
            left = np.einsum("ij,ij->i", corners[a], rotated[b]) / factor[a] + width[a] >= self.threshold
            yield from self.exact(x, a[left], b[left])
        for start, length in zip(starts[~short], lengths[~short]):
            for top in range(start, start + length, STRIP):
                strip, rest = slice(top, min(top + STRIP, start + length)), slice(top, start + length)
                estimate = corners[strip] @ rotated[rest].T / factor[strip, None]
                a, b = np.nonzero(np.triu(estimate + width[strip, None] >= self.threshold, 1))
                yield from self.exact(x, a + top, b + top)


def _links(classes: DataFrame, size: int, threshold: float) -> DataFrame:
    """Per class ``rep``: ``links`` (vectors in linked classes) and ``root``, in parts of which many may be of one class."""
    bits, tables = layout(classes.count(), threshold)
    codes, stored = Codes(size, bits * tables), Codes(size, size, SEED + 1)
    comparison = Comparison(stored, threshold)
    kind = classes.schema["rep"].dataType.simpleString()
    vector = classes.schema["vector"].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            x = matrix(batch.column("vector"), size).astype(np.float64)
            signs = codes.rotated(x)[:, : bits * tables].reshape(len(x), tables, bits) >= 0
            keys = (signs * weights).sum(axis=2).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.reshape(-1)))
            rotated = stored.rotated(x)
            columns = [*(batch.column(c) for c in ("label", "rep", "n", "vector")), column, stored.packed(rotated), pa.array(stored.factor(rotated))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "rep", "n", "vector", "keys", "code", "factor"])

    label = classes.schema["label"].dataType.simpleString()
    coded = classes.mapInArrow(keyed, f"label {label}, rep {kind}, n bigint, vector {vector}, keys array<int>, code binary, factor double")
    coded = written(coded, "codes")
    placed = coded.select("label", "rep", F.posexplode("keys").alias("t", "key"))
    sizes = placed.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    bucket = F.xxhash64("label", "t", "key").alias("bucket")
    sizes = sizes.select(bucket, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")).groupBy("bucket").agg(F.max("blocks").alias("blocks"))
    rows = coded.select("*", F.posexplode("keys").alias("t", "key")).withColumn("bucket", F.xxhash64("label", "t", "key"))
    rows = rows.join(spread(sizes, "bucket"), "bucket")
    # Block b of a large bucket meets every block, itself included, each pair of blocks in a group of its own.
    rows = rows.withColumn("b", F.pmod(F.xxhash64("rep", "t"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("b", "c"), "hi": F.greatest("b", "c")}).drop("c", "blocks", "key")
    group = ["bucket", "lo", "hi"]
    tasks = max(2, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(tasks, *group).sortWithinPartitions(*group, "rep")

    def starts_of(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
        marks = np.column_stack([rows.column(c).to_numpy() for c in group])
        return np.concatenate([[0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1])

    def compare(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Links in whole groups of rows. A pair counts in the first table in which it shares a bucket."""
        starts = starts_of(rows)
        lengths = np.diff(np.concatenate([starts, [rows.num_rows]]))
        x = matrix(rows.column("vector"), size).astype(np.float64)
        t, lo, hi, b, n, factor = (rows.column(c).to_numpy() for c in ("t", "lo", "hi", "b", "n", "factor"))
        label, keys = rows.column("label").dictionary_encode().indices.to_numpy(), matrix(rows.column("keys"), tables)
        links, root, linked = np.zeros(len(n), np.int64), np.arange(len(n)), np.zeros(len(n), bool)
        for i, j in comparison.of_runs(x, stored.corners(rows.column("code")), factor, lengths):
            # Rows of one block meet in the group of that block alone; other labels only share a hash.
            valid = (label[i] == label[j]) & ((lo[i] == hi[i]) | (b[i] != b[j]))
            i, j = i[valid], j[valid]
            if not len(i):
                continue
            earlier = np.arange(tables)[None, :] < t[i][:, None]
            first = ~((keys[i] == keys[j]) & earlier).any(axis=1)
            np.add.at(links, i[first], n[j[first]])
            np.add.at(links, j[first], n[i[first]])
            linked[i] = linked[j] = True
            # The links so far are those of every row with its root.
            root = _roots(len(n), np.concatenate([np.arange(len(n)), i]), np.concatenate([root, j]))
        rep, at = rows.column("rep"), np.flatnonzero(linked)
        return pa.RecordBatch.from_arrays([rep.take(pa.array(at)), pa.array(links[at]), rep.take(pa.array(root[at]))], ["rep", "links", "root"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([*([held] if held else []), batch]).combine_chunks().to_batches()[0]
            # The last group may go on in the next batch; it has the rows of two blocks at most.
            last = int(starts_of(held)[-1])
            if last:
                yield compare(held.slice(0, last))
                held = held.slice(last)
        if held:
            yield compare(held)

    return dealt.mapInArrow(compared, f"rep {kind}, links bigint, root {kind}")


def near_duplicates(
    rows: DataFrame, threshold: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per row: its id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their labels are equal and their cosine, in double precision, is at least
    ``threshold``. ``n_links`` counts the other rows linked with a row, ``component_id`` is the smallest id that
    links reach, and ``kept`` says that it is the row's own.

    Equal vectors are one class, so copies are never paired. Classes meet in buckets of code bits, in several
    tables; a pair at the threshold is missed with probability ``MISSED``, closer ones far more rarely. Each class
    has a stored code, a sign for each component after a rotation of its own, and the code's correction factor. A pair in a
    bucket is estimated from one side's code and factor; unless the upper confidence bound is below the
    threshold, it is computed exactly, so no link is wrong.

    Vectors of each size are compared among themselves. Rows without id or label or with an unusable vector link
    with nothing: no links, their own id as component, and kept. Repeated rows link with each other as equal vectors do.
    """
    given = rows.select(F.col(id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    valid = given.where(sound)
    alone = given.where(~sound).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    sizes = sizes_of(valid, "vector")
    if sizes:
        classes = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
        # Numbered once, when written; an id may stand in more than one class.
        classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
        classed = classes.select("label", "rep", "n", "vector")
        links = [_links(classed.where(F.size("vector") == size), size, threshold) for size in sizes]
        parts = written(reduce(DataFrame.unionByName, links), "links")
        counts = parts.groupBy("rep").agg(F.sum("links").alias("links"))
        roots = components(parts.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
        member = classes.join(counts, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        least = member.groupBy("root").agg(F.min("first").alias("component_id"))
        known = member.join(spread(least, "root"), "root")
        known = known.select("label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
        linked = valid.join(spread(known, "vector"), ["label", "vector"]).select("vec_id", "n_links", "component_id")
        alone = linked.unionByName(alone)
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return alone.select(F.col("vec_id").alias(id), "n_links", "component_id", kept.alias("kept"))
