import math

import numpy as np
import pyarrow as pa
import pytest

from gleanery.checks.base import table
from gleanery.llm import neighbours, rotated_codes
from gleanery.llm.queries import QUERIES

from .conftest import Sets

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, root string"
NAN, INF = math.nan, math.inf


def embeddings(spark, path):
    rows = sorted(table(spark, path, "embeddings").collect(), key=lambda r: r.vec_id)
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float), [r.label for r in rows]


def clustered(n=600, size=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, size))
    x = centres[rng.integers(0, 12, n)] * rng.uniform(0.5, 2, (n, 1)) + rng.normal(0, 0.07, (n, size))
    x[50:90] = x[40]  # copies
    return x.astype(np.float32).astype(float), rng.integers(0, 3, n)


def nearest(ids, x, query, k):
    scores = x @ x[query]
    order = np.lexsort((ids, -scores))
    return [(int(ids[i]), scores[i]) for i in order if i != query][:k]


@pytest.fixture
def odd_vectors(spark):
    rows = [
        (20, [1.0, 0.0], 1), (21, [1.0, 0.0], 1), (22, [0.9, 0.1], 1), (40, None, 1), (41, [0.0, 0.0], 1), (60, [1.0, None], 1),
        (61, [1.0, NAN], 1), (62, [INF, 1.0], 1), (80, [1.0, 0.0, 0.0], 1), (100, [], 1), (None, [1.0, 0.0], 1), (120, [1.0, 0.0], None),
        (140, [2.0, 0.0], 1), (20, [1.0, 0.0], 1), (160, [-1.0, 0.0], 2),
    ]
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA)


def test_neighbours_query(spark):
    ids, x, _ = embeddings(spark, SF)
    rows = QUERIES["op5_forest_neighbours"](spark, SF).collect()
    for q in np.flatnonzero(ids % 20 == 0):
        got = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == ids[q])
        want = nearest(ids, x, q, 20)  # the table is small, so all rows are examined
        assert [(r, i) for r, i, _ in got] == [(n + 1, i) for n, (i, _) in enumerate(want)]
        assert np.allclose([s for *_, s in got], [s for _, s in want], atol=1e-12, rtol=0)


def test_neighbours_recall_when_few_rows_are_examined(spark):
    x, _ = clustered(3000)
    ids = np.arange(len(x))
    rows = spark.createDataFrame([(int(i), v.tolist(), 0, 1, "") for i, v in zip(ids, x)], SCHEMA)
    found = neighbours.nearest(rows, "vec_id % 20 = 0", k=10, examined=4000).collect()
    hits = 0
    for q in range(0, len(x), 20):
        kth = nearest(ids, x, q, 10)[-1][1]
        mine = [r for r in found if r.query_id == q]
        assert len(mine) == 10 and all(abs(r.score - x[q] @ x[r.vec_id]) < 1e-9 for r in mine)
        hits += sum(r.score >= kth - 1e-9 for r in mine)
    assert hits / (10 * len(range(0, len(x), 20))) > 0.9


@pytest.mark.parametrize("n", [15_000, 30_000])
def test_neighbours_recall_without_structure(spark, monkeypatch, n):
    """The search is partial at both sizes, since few leaf rows are examined unless recall needs more."""
    monkeypatch.setattr(neighbours, "EXAMINED", 500)
    x = np.random.default_rng(1).standard_normal((n, 64)).astype(np.float32)
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float32()))
    rows = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(n)), "embedding": vectors}))
    queries = np.arange(0, n, n // 250)
    kth = np.empty(len(queries))
    for at in range(0, len(queries), 50):
        some = queries[at : at + 50]
        scores = x[some] @ x.T
        scores[np.arange(len(some)), some] = -np.inf
        # Single precision picks the candidates, double precision ranks them.
        near = np.argpartition(-scores, 40, axis=1)[:, :40]
        exact = np.einsum("qd,qkd->qk", x[some].astype(float), x[near].astype(float))
        kth[at : at + 50] = np.sort(exact, axis=1)[:, -20]
    found = neighbours.nearest(rows, f"vec_id % {n // 250} = 0").toArrow()
    at = np.searchsorted(queries, found["query_id"].to_numpy())
    assert (np.bincount(at) == 20).all()
    assert (found["score"].to_numpy() >= kth[at] - 1e-9).sum() / (20 * len(queries)) >= 0.9


def test_best_of_no_candidates():
    assert not len(neighbours._Best(3).compact()[0])


def test_reach_is_what_the_search_needs():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 8)).astype(np.float32)
    trees = [neighbours.plant(x, 5, seed) for seed in range(3)]
    sizes = np.array([np.bincount(t.leaves(x), minlength=32) for t in trees])
    for query, reach in zip(x[:20], neighbours.reached(trees, x[:20], sizes)):
        for examined in (1, 300, 1500, 6000):
            found = {t * 32 + leaf for t, leaf in next(neighbours.search(trees, query[None], list(sizes), examined))}
            assert set(np.flatnonzero((reach <= examined) & (sizes.ravel() > 0))) <= found


def test_neighbours_odd_rows(spark, odd_vectors):
    rows = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(odd_vectors, "vec_id % 20 = 0", k=3).collect())
    by = {q: [(i, round(s, 6)) for a, _, i, s in rows if a == q] for q in {r[0] for r in rows}}
    assert by == {
        20: [(140, 2.0), (21, 1.0), (120, 1.0)],
        120: [(140, 2.0), (20, 1.0), (21, 1.0)],
        140: [(20, 2.0), (21, 2.0), (120, 2.0)],
        160: [(22, -0.9), (20, -1.0), (21, -1.0)],
    }
    assert neighbours.nearest(odd_vectors.limit(0), "vec_id % 20 = 0").count() == 0


def test_many_copies_are_all_considered(spark):
    rows = [(i, [1.0, 2.0], 0, 1, "") for i in range(500)] + [(1000, [5.0, 5.0], 0, 1, "")]
    found = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), "vec_id % 100 = 0", k=5).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 400, 1000)}
    assert got == {0: [1000, 1, 2, 3, 4], 400: [1000, 0, 1, 2, 3], 1000: [0, 1, 2, 3, 4]}


def linked(ids, x, labels, threshold=0.98):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= threshold) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    sets = Sets(range(len(ids)))
    for i, j in zip(*np.nonzero(near)):
        sets.join(int(i), int(j))
    return {int(ids[i]): (int(near[i].sum()), int(ids[sets.find(i)])) for i in range(len(ids))}


@pytest.mark.parametrize("block", [16, 256])
def test_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(rotated_codes, "BLOCK", block)
    monkeypatch.setattr(rotated_codes, "MISSED", 1e-6)
    x, labels = clustered()
    rows = [(i, v.tolist(), int(label), 1, "") for i, (v, label) in enumerate(zip(x, labels))]
    found = rotated_codes.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == linked(np.arange(len(x)), x, labels)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_links_query(spark):
    ids, x, labels = embeddings(spark, SF)
    found = QUERIES["op9_rotated_code_dedup"](spark, SF).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == linked(ids, x, labels)


def test_links_odd_rows(spark, odd_vectors):
    found = rotated_codes.near_duplicates(odd_vectors).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=str)
    alone = [(i, 0, i, True) for i in (40, 41, 60, 61, 62, 80, 100, 120, 160, None)]
    group = [(20, 4, 20, True), (20, 4, 20, True), (21, 4, 20, False), (22, 4, 20, False), (140, 4, 20, False)]
    assert got == sorted(alone + group, key=str)
    assert rotated_codes.near_duplicates(odd_vectors.limit(0)).count() == 0


def test_every_size_of_vectors_takes_part(spark):
    x, labels = clustered(200)
    rare, _ = clustered(100, size=9, seed=5)
    rows = [(i, v.tolist(), int(label), 1, "") for i, (v, label) in enumerate(zip([*x, *rare], [*labels, *labels[:100]]))]
    table = spark.createDataFrame(rows, SCHEMA)
    found = {r.vec_id: (r.n_links, r.component_id) for r in rotated_codes.near_duplicates(table).collect()}
    ids = np.arange(200, 300)
    assert found == linked(np.arange(200), x, labels) | linked(ids, rare, labels[:100])
    assert any(found[i][0] for i in ids)
    near = neighbours.nearest(table, "vec_id % 20 = 0", k=5).collect()
    for q in range(0, 300, 20):
        want = nearest(np.arange(200), x, q, 5) if q < 200 else nearest(ids, rare, q - 200, 5)
        assert [r.vec_id for r in sorted(near, key=lambda r: r.rank) if r.query_id == q] == [i for i, _ in want]


def test_bounds_hold_and_estimates_are_unbiased():
    rng = np.random.default_rng(4)
    codes = rotated_codes.Codes(64, 192)
    a, b = rng.standard_normal((2, 2000, 64))
    b = a * rng.uniform(0, 2, (2000, 1)) + b
    ra, rb = codes.rotated(a), codes.rotated(b)
    factor = codes.factor(ra)
    estimate = np.einsum("ij,ij->i", np.where(ra >= 0, 1, -1) / math.sqrt(codes.n), rb) / factor
    true = np.einsum("ij,ij->i", a, b) / np.linalg.norm(a, axis=1) / np.linalg.norm(b, axis=1)
    assert abs((estimate - true).mean()) < 0.01
    assert (np.abs(estimate - true) <= codes.width(factor)).mean() > 0.999


@pytest.mark.parametrize("size", [3, 64, 70])
def test_stored_codes_give_back_their_corners(size):
    codes = rotated_codes.Codes(size, size, 7)
    rotated = codes.rotated(np.random.default_rng(5).standard_normal((50, size)))
    corners = codes.corners(codes.packed(rotated))
    assert np.allclose(corners, np.where(rotated >= 0, 1, -1) / math.sqrt(size))
    assert np.allclose((corners * rotated).sum(axis=1), codes.factor(rotated))


def test_a_run_of_many_strips(monkeypatch):
    """Links of long and of short runs, whole although they come in small steps."""
    monkeypatch.setattr(rotated_codes, "STRIP", 32)
    monkeypatch.setattr(rotated_codes, "PAIRS", 50)
    x, _ = clustered(400)
    codes = rotated_codes.Codes(x.shape[1], x.shape[1], 7)
    rotated = codes.rotated(x)
    lengths = np.array([1, 5, 300, 20, 74])
    found = rotated_codes.Comparison(codes, 0.98).of_runs(x, codes.corners(codes.packed(rotated)), codes.factor(rotated), lengths)
    got = [(int(a), int(b)) for i, j in found for a, b in zip(i, j)]
    unit, run = x / np.linalg.norm(x, axis=1, keepdims=True), np.repeat(np.arange(5), lengths)
    near = np.triu((unit @ unit.T >= 0.98) & (run[:, None] == run[None, :]), 1)
    assert sorted(got) == [tuple(map(int, p)) for p in np.argwhere(near)] and got
