import math

import numpy as np
import pytest

from gleanery.checks.base import table
from gleanery.llm import whitening
from gleanery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, component int, x string"
NAN, INF = float("nan"), float("inf")
RNG = np.random.default_rng(5)
TURNED = np.linalg.qr(RNG.standard_normal((7, 7)))[0]


def brute(vectors, count=32):
    """Eigenvalues, |projections| and deviations, by the library's solver and whole numbers."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    centred = ((n * x - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return values, centred @ vectors, deviation, float(np.trace(centred.T @ centred / n))


@pytest.mark.parametrize(
    "matrix",
    [
        np.eye(9), np.zeros((4, 4)), np.diag([3.0, 3, 3, 2, 2, 1, 0]), np.ones((12, 12)), np.array([[0.0, 1], [1, 0]]), np.array([[2.0]]),
        TURNED @ np.diag([1, 1 + 1e-12, 1 + 1e-9, 0.5, 0.5 + 1e-13, 0.2, 1e-9]) @ TURNED.T, np.cov(RNG.standard_normal((40, 300))),
        np.cov(RNG.standard_normal((6, 30)).T), np.diag([-1.0, -2, 5, 5]),
    ],
)
def test_spectrum(matrix):
    found = whitening.Spectrum(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(found.values - want).max() < 1e-12 * scale
    assert np.abs(matrix @ found.vectors - found.vectors * found.values).max() < 1e-12 * scale
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(want))).max() < 1e-12


def test_counts_are_those_of_the_eigenvalues():
    for seed in range(60):
        rng = np.random.default_rng(seed)
        x = rng.integers(-2, 3, (int(rng.integers(1, 12)), int(rng.integers(2, 10)))).astype(float)
        values = np.linalg.eigvalsh(x.T @ x)
        for shift in (-0.5, 0.25, 1.5, float(values.mean()) + 0.01, 100.0):
            assert whitening.Shifted(x.T @ x, shift).above == (values > shift).sum()
            b = rng.standard_normal(len(values))
            assert np.allclose((x.T @ x - shift * np.eye(len(b))) @ whitening.Shifted(x.T @ x, shift).solve(b), b, atol=1e-6)


def test_a_wrong_number_is_not_certified():
    found = whitening.Spectrum(np.diag([4.0, 3, 2, 1]), 3)
    found.values = found.values[[0, 2, 1]]
    with pytest.raises(ArithmeticError):
        found._certify()


def test_query(spark):
    vectors = {r.vec_id: r.embedding for r in table(spark, SF, "embeddings").collect()}
    values, projected, deviation, trace = brute(list(vectors.values()))
    rows = QUERIES["op11_spectrum_whitening"](spark, SF).collect()
    assert len(rows) == 32 * len(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    signs = {}
    for i, vec_id in enumerate(vectors):
        for k in range(32):
            r = by[vec_id, k + 1]
            want = projected[i, k] / math.sqrt(values[k])
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(r.whitened) - abs(want)) < 1e-8 and abs(r.explained / (values[k] / trace) - 1) < 1e-9
            assert (r.n, r.deviation) == (len(vectors), deviation[i]) and r.identity_error < 1e-9


def test_odd_rows(spark):
    given = [
        (1, [1.0, 0.0, 2.0]), (2, [0.5, 1.5, -1.0]), (2, [0.5, 1.5, -1.0]), (3, [0.0, 0.0, 0.0]), (None, [3.0, 1.0, 1.0]), (4, None),
        (5, [1.0, None, 1.0]), (6, [NAN, 1.0, 1.0]), (7, [INF, 0.0, 0.0]), (8, []), (9, [1.0, 2.0]), (10, [1.0, 2.0]),
    ]
    rows = spark.createDataFrame([(i, v, 7, "y") for i, v in given], SCHEMA)
    fits = whitening.fit(rows)
    found = whitening.whiten(rows, fits).collect()
    assert sorted((str(r.vec_id), r.component) for r in found) == sorted(
        [(i, k) for i in ("1", "2", "2", "3", "None") for k in (1, 2, 3)] + [(i, k) for i in ("9", "10") for k in (1, 2)]
    )
    values, projected, deviation, _ = brute([v for i, v in given if v and len(v) == 3 and i not in (5, 6, 7)])
    assert {r.deviation for r in found if r.n == 5} == set(deviation) and np.allclose(fits[3].values, values)
    # Two equal rows: no variance, so nothing to scale by.
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found if r.n == 2} == {(2, 0, None, 0.0, 0.0)}
    empty = rows.limit(0)
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0
    assert whitening.whiten(rows.where("vec_id = 9"), fits).count() == 2


def test_fewer_rows_than_components(spark):
    x = np.random.default_rng(0).standard_normal((4, 9))
    rows = spark.createDataFrame([(i, v.tolist(), 0, "") for i, v in enumerate(x)], SCHEMA)
    found = whitening.whiten(rows, whitening.fit(rows, components=6)).collect()
    assert all((r.whitened is None) == (r.component > 3) == (r.explained == 0) for r in found) and len(found) == 24
    assert max(r.identity_error for r in found) < 1e-9


def test_very_large_components(spark):
    """Sums and deviations pass 64 bits; a deviation that does is NULL."""
    vectors = [[1e17, 1.0], [-1e17, 2.0], [3e5, 3.0], [3e5, 4.0]]
    rows = spark.createDataFrame([(i, v, 0, "") for i, v in enumerate(vectors)], SCHEMA)
    found = whitening.whiten(rows, whitening.fit(rows)).collect()
    *_, deviation, _ = brute(vectors)
    assert {(r.vec_id, r.deviation) for r in found} == {(i, d if d < 1 << 63 else None) for i, d in enumerate(deviation)}
