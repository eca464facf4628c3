"""Whitening of embeddings on the leading eigenvectors of their covariance, found by spectrum slicing."""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import matrix, sizes_of

#: Vectors are put on a grid of 1 / GRID and moved by SHIFT, so that sums are sums of whole numbers.
GRID, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Share of the largest eigenvalue, for each dimension, below which an eigenvalue is rounding.
ROUNDING = 2.0**-52
#: Bunch and Kaufman's bound for taking a single pivot.
SINGLE = (1 + 17**0.5) / 8
LONG = 1 << 63


class Shifted:
    """``P (A - shift I) Pᵀ = L D Lᵀ`` with pivots of one or two rows (Bunch-Kaufman).

    ``above`` is the number of eigenvalues of ``A`` over ``shift``, by Sylvester's law of inertia the
    number of positive eigenvalues of ``D``; ``solve`` uses the same factors.
    """

    def __init__(self, matrix: np.ndarray, shift: float):
        a = matrix - shift * np.eye(len(matrix))
        size, self.order, self.blocks, self.above = len(a), np.arange(len(a)), [], 0
        #: What is less than this is rounding: a pivot becomes this large, so that solving goes on, and counts as not above.
        tiny = max(float(np.abs(matrix).max(initial=0)), abs(shift)) * ROUNDING or 1.0
        k = 0
        while k < size:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax()) if len(column) else k
            largest, step, pivot = column.max(initial=0), 1, k
            if tiny < largest and abs(a[k, k]) < SINGLE * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                beyond = row.max()
                if abs(a[k, k]) * beyond < SINGLE * largest * largest:
                    pivot, step = (r, 1) if abs(a[r, r]) >= SINGLE * beyond else (r, 2)
            if pivot != (at := k + step - 1):
                a[[at, pivot]] = a[[pivot, at]]
                a[:, [at, pivot]] = a[:, [pivot, at]]
                self.order[[at, pivot]] = self.order[[pivot, at]]
            if max(abs(a[k, k]), largest) <= tiny:
                step, a[k, k], a[k + 1 :, k], a[k, k + 1 :] = 1, -tiny, 0, 0
            block, rest = a[k : k + step, k : k + step].copy(), slice(k + step, size)
            self.blocks.append((k, block))
            if step == 1:
                self.above += int(block[0, 0] > 0)
            else:  # Of such a block one eigenvalue is positive and one negative.
                self.above += 1
            held = a[rest, k : k + step].copy()
            factor = held @ np.linalg.inv(block)
            a[rest, rest] -= factor @ held.T
            a[rest, k : k + step] = factor
            k += step
        self.factors = a

    def solve(self, b: np.ndarray) -> np.ndarray:
        x, a = b[self.order].copy(), self.factors
        for k, block in self.blocks:
            step = len(block)
            x[k + step :] -= a[k + step :, k : k + step] @ x[k : k + step]
        for k, block in self.blocks:
            x[k : k + len(block)] = np.linalg.solve(block, x[k : k + len(block)])
        for k, block in reversed(self.blocks):
            step = len(block)
            x[k : k + step] -= a[k + step :, k : k + step].T @ x[k + step :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Spectrum:
    """The leading eigenvalues of a symmetric matrix and their unit eigenvectors, the largest first.

    Counts of eigenvalues over a shift cut the spectrum into slices until each leading eigenvalue has a
    slice of its own, or a slice is too narrow to be cut (equal eigenvalues). In its slice, Rayleigh
    quotient iteration finds the eigenvalue, at right angles to the vectors found before; if it leaves
    the slice, the slice is halved first. At last, counts on both sides of every
    value must agree with its number.
    """

    def __init__(self, matrix: np.ndarray, count: int):
        self.matrix, self.size = matrix, len(matrix)
        self.counts: dict[float, int] = {}
        reach = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        self.low, self.high = float((np.diag(matrix) - reach).min()), float((np.diag(matrix) + reach).max())
        self.scale = max(abs(self.low), abs(self.high))
        #: What a value or a residual may be off by.
        self.off = 8 * self.size * ROUNDING * self.scale
        self.low, self.high = self.low - 2 * self.off, self.high + 2 * self.off
        self.values, self.vectors = np.zeros(0), np.zeros((self.size, 0))
        if self.scale > 0:
            for slice_ in self._slices(min(count, self.size)):
                self._add(*slice_)
            order = np.argsort(-self.values, kind="stable")[:count]
            self.values, self.vectors = self.values[order], self.vectors[:, order]
            self._certify()
        else:
            self.values, self.vectors = np.zeros(min(count, self.size)), np.eye(self.size)[:, : min(count, self.size)]

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = Shifted(self.matrix, shift).above
        return self.counts[shift]

    def _slices(self, count: int) -> list[tuple[float, float, int]]:
        """``(low, high, eigenvalues between)``, the highest first, that hold the first ``count`` ones."""
        open_, done = [(self.low, self.high)], []
        while open_:
            low, high = open_.pop()
            inside = self.above(low) - self.above(high)
            if not inside or self.above(high) >= count:
                continue
            middle = (low + high) / 2
            if inside == 1 or high - low <= 2 * self.off or not low < middle < high:
                done.append((low, high, inside))
            else:
                open_ += [(low, middle), (middle, high)]
        return sorted(done, reverse=True)

    def _add(self, low: float, high: float, inside: int) -> None:
        for _ in range(inside):
            value, vector = self._iterate(low, high)
            self.values, self.vectors = np.append(self.values, value), np.column_stack([self.vectors, vector])

    def _iterate(self, low: float, high: float) -> tuple[float, np.ndarray]:
        held = self.vectors

        def away(v: np.ndarray) -> np.ndarray:
            for _ in range(2):
                v = v - held @ (held.T @ v)
            return v / np.linalg.norm(v)

        # Each vector of a slice starts elsewhere: what one start holds of equal eigenvalues is one direction.
        start = away(np.random.default_rng(held.shape[1]).normal(size=self.size))
        while True:
            vector, shift, best = start, (low + high) / 2, None
            narrow = high - low <= 2 * self.off
            for _ in range(30):
                vector = away(Shifted(self.matrix, shift).solve(vector))
                image = self.matrix @ vector
                value = float(vector @ image)
                residual = float(np.linalg.norm(image - value * vector))
                if not low - self.off <= value <= high + self.off:
                    if residual <= self.off or narrow:
                        break
                    shift = (low + high) / 2  # not yet near: once more from the middle
                    continue
                if best and residual >= best[0] / 2:
                    if best[0] <= self.off:
                        return best[1:]
                elif best is None or residual < best[0]:
                    best = (residual, value, vector)
                shift = value
            if best and (narrow or best[0] <= self.off):
                return best[1:]
            if narrow:
                raise ArithmeticError(f"no eigenvector between {low} and {high}")
            middle = (low + high) / 2
            low, high = (middle, high) if self.above(middle) > self.above(high) else (low, middle)

    def _certify(self) -> None:
        """Of each value: at least its number of eigenvalues lie over a little less, and fewer over a little more."""
        for number, value in enumerate(self.values.tolist(), start=1):
            if not self.above(value - 3 * self.off) >= number > self.above(value + 3 * self.off):
                raise ArithmeticError(f"eigenvalue {number} of {self.size} is not certified")


def eligible(vector: Column) -> Column:
    """Not NULL, and without NULL or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def on_grid(values: np.ndarray) -> np.ndarray:
    """``floor(GRID * value) + SHIFT``; beyond 64 bits as whole numbers of any size."""
    scaled = np.floor(values.astype(np.float64) * GRID)
    if np.abs(scaled).max(initial=0) < 2.0**62:
        return scaled.astype(np.int64) + SHIFT
    return np.array([[int(x) for x in row] for row in scaled.tolist()], object).reshape(scaled.shape) + SHIFT


def _exact(x: np.ndarray, most: int) -> np.ndarray:
    """``x`` as 64-bit numbers if results of up to ``most`` fit, else as whole numbers of any size."""
    return x if x.dtype != object and most < LONG else x.astype(object)


@dataclass
class Fit:
    """What the rows of one size have in common: their number, the sums, and the leading components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    def apart(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly."""
        most = max([abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))])
        sums = np.array(self.sums, object)
        whole = _exact(x, self.n * most + max([abs(s) for s in self.sums], default=0))
        return whole * self.n - (sums if whole.dtype == object else sums.astype(np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        apart = self.apart(x)
        most = max([abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0)))])
        apart = _exact(apart, apart.shape[1] * most * most)
        found = [int(d) for d in (apart * apart).sum(axis=1)] if apart.shape[1] else [0] * len(apart)
        return [d if d < LONG else None for d in found]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Columns of components without variance are NaN."""
        roots = np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (self.centred(x) @ self.vectors) / roots


def _sums(rows: DataFrame, vector: str, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums of their components."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, object)
        for batch in batches:
            x = on_grid(matrix(batch.column(0), size)) if batch.num_rows else np.zeros((0, size), np.int64)
            most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
            sums = sums + _exact(x, len(x) * most).sum(axis=0)
            n += batch.num_rows
        if n:
            numbers = [decimal.Decimal(int(s)) for s in [n, *sums]]
            yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(numbers, pa.decimal128(38, 0))], ["i", "total"])

    found = rows.select(vector).mapInArrow(partial, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).collect()
    totals = [int(r["total"]) for r in sorted(found, key=lambda r: r["i"])]
    return totals[0], totals[1:]


def _products(rows: DataFrame, vector: str, size: int, width: int, values) -> np.ndarray:
    """Sum over the rows of ``values(x)ᵀ values(x)``, ``width`` columns, row by row of the result."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, places = None, np.arange(width * width)
        for batch in batches:
            if batch.num_rows:
                given = values(on_grid(matrix(batch.column(0), size)))
                total = given.T @ given + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(places // width, pa.int32()), pa.array(places % width, pa.int32()), pa.array(total.ravel())], ["i", "j", "total"])

    summed = rows.select(vector).mapInArrow(partial, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    entries, out = summed.toArrow(), np.zeros((width, width))
    out[entries["i"].to_numpy(), entries["j"].to_numpy()] = entries["total"].to_numpy()
    return (out + out.T) / 2


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """By number of components of a vector: the leading eigenvectors of the covariance of all such vectors.

    Tasks add up whole numbers first, then products of centred vectors; the driver gets one covariance
    matrix for each size, and slices its spectrum. A third pass adds up the products of the whitened
    vectors, for ``error``, the largest entry of their covariance minus the identity.
    """
    rows, fits = embeddings.where(eligible(F.col(vector))), {}
    for size in sizes_of(rows, vector):
        some = rows.where(F.size(vector) == size)
        if not size:
            continue
        n, sums = _sums(some, vector, size)
        found = Fit(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
        covariance = _products(some, vector, size, size, found.centred) / n
        spectrum = Spectrum(covariance, components)
        found.trace = float(np.trace(covariance))
        real = spectrum.values > size * ROUNDING * max(spectrum.values.max(initial=0), 0)
        found.values, found.vectors = np.where(real, spectrum.values, 0.0), spectrum.vectors
        k = int(real.sum())
        if k:
            # The whitened vectors' mean, by the sums, is zero but for rounding of a centred vector.
            whitened = _products(some, vector, size, k, lambda x, fit=found, k=k: fit.whitened(x)[:, :k]) / n
            found.error = float(np.abs(whitened - np.eye(k)).max())
        fits[size] = found
    return fits


def whiten(embeddings: DataFrame, fits: dict[int, Fit], id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector and component: the id, ``component, n, deviation, whitened, explained, identity_error``.

    Vectors that are NULL or hold NULL or non-finite components are left out, and so are those without
    components; zero vectors take part. Vectors of each size are fitted among themselves. Components are
    numbered from 1 by falling eigenvalue. One without variance (a table of equal rows, or of fewer rows
    than components) has ``explained`` 0 and ``whitened`` NULL. ``deviation`` is NULL where it passes 64 bits.
    Repeated rows count and are returned each; other columns are left out; an empty table gives no rows.
    """
    schema = f"id {embeddings.schema[id].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            for size in np.unique(sizes).tolist():
                found = fits.get(size)
                if found is None:
                    continue
                own = batch.filter(pa.array(sizes == size))
                x, k = on_grid(matrix(own.column("v"), size)), len(found.values)
                values, each = found.whitened(x), own.num_rows
                explained = found.values / found.trace if found.trace else np.zeros(k)
                columns = [
                    own.column("id").take(pa.array(np.repeat(np.arange(each), k))),
                    pa.array(np.tile(np.arange(1, k + 1), each), pa.int32()),
                    pa.array(np.full(each * k, found.n)),
                    pa.array([d for d in found.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(values.ravel(), mask=np.isnan(values.ravel())),
                    pa.array(np.tile(explained, each)),
                    pa.array(np.full(each * k, found.error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = embeddings.where(eligible(F.col(vector))).select(F.col(id).alias("id"), F.col(vector).alias("v"))
    return rows.mapInArrow(rows_of, schema).withColumnRenamed("id", id)
