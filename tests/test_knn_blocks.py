"""The block kNN against brute force: several parts and blocks, ties, repeated ids, rows without a usable vector."""

import numpy as np
import pytest

from turnstone.operators import knn
from turnstone.operators.knn import knn_join

SCHEMA = "id long, vec array<double>"


def _brute(ids, x, k):
    total = np.zeros((len(x), len(x)))
    for j in range(x.shape[1]):
        diff = x[:, j][:, None] - x[None, :, j]
        total += diff * diff
    dist = np.sqrt(total)
    np.fill_diagonal(dist, np.inf)
    return {(int(ids[i]), r): (int(ids[j]), float(dist[i, j])) for i in range(len(ids))
            for r, j in enumerate(np.lexsort((ids, dist[i]))[:k], 1)}


def _found(df):
    return {(r["id"], r["rank"]): (r["neighbor_id"], r["distance"]) for r in df.collect()}


@pytest.mark.parametrize("form", ["slab", "lattice", "uniform"])
def test_blocks_and_parts_are_exact(spark, form):
    rng = np.random.default_rng(7)
    n = 900
    x = {"slab": np.c_[np.round(1e5 * rng.random(n), 2), rng.integers(0, 40, (n, 1)), rng.integers(0, 2, (n, 5))],
         "lattice": np.unique(rng.integers(0, 8, (n, 3)), axis=0) + np.array([1e6, 0, 0]),
         "uniform": rng.normal(size=(n, 24))}[form].astype(float)
    ids = rng.permutation(len(x)).astype(np.int64) - 100
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    assert _found(knn_join(df, k=4, cell_target=32)) == _brute(ids, x, 4)


def test_pairs_of_rows_never_become_rows(spark):
    """The answers are read from a staged table of n x k rows; no join or window over pairs stands before it."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(200)], SCHEMA)
    found = knn._knn_core(df, None, 3, "id", "vec", True, 16, 42, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Scan parquet" in plan
    assert found.count() == 600


def test_rows_without_a_usable_vector_are_left_out(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [0.0, None]),
                                (6, [5.0, 0.0])], SCHEMA)
    assert _found(knn_join(df, k=1)) == {(1, 1): (2, 1.0), (2, 1): (1, 1.0), (6, 1): (2, 4.0)}


def test_data_rows_of_another_frame_in_many_parts(spark):
    rng = np.random.default_rng(5)
    x, y = 10 * rng.random((80, 3)), 10 * rng.random((300, 3))
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], SCHEMA)
    got = _found(knn_join(q, d, k=2, cell_target=16))
    dist = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(-1))
    assert {key: v[0] for key, v in got.items()} == {
        (i, r): int(j) for i in range(80) for r, j in enumerate(np.argsort(dist[i])[:2], 1)}


def test_a_rounded_product_cannot_lose_a_neighbour():
    """Vectors far from the origin, whose product of matrices has no digits left for the small differences."""
    rng = np.random.default_rng(9)
    x = 1e9 + np.round(rng.random((300, 4)) * 64) / 64
    x = np.unique(x, axis=0)
    ids = np.arange(len(x))
    q = knn._Queries(ids, x, 3, True)
    q.probe(ids, x, x.min(axis=0), x.max(axis=0))
    want = _brute(ids, x, 3)
    assert {(i, r + 1): (int(q.nid[i, r]), float(q.dist[i, r])) for i in ids.tolist() for r in range(3)} == want


def test_blocks_are_small_enough_to_prune(monkeypatch):
    """Vectors that spread along two dimensions: a query is measured against a small share of the rows."""
    r = np.random.default_rng(4)
    x = np.column_stack([r.random(8192) * 1e6, r.random(8192) * 1e5, r.integers(0, 2, (8192, 6))])
    ids, cells, real = np.arange(len(x)), [], knn._Queries._probe
    monkeypatch.setattr(knn._Queries, "_probe", lambda self, rows, i, y, *a: (cells.append(len(rows) * len(y)), real(self, rows, i, y, *a)))
    blocks = [(b, x[b].min(axis=0), x[b].max(axis=0)) for b in knn._halved(x, ids, knn.BLOCK)]
    for b, lo, hi in blocks:
        q = knn._Queries(ids[b], x[b], 3, True)
        for o, olo, ohi in sorted(blocks, key=lambda z: knn._gap2(z[1], z[2], q.lo, q.hi) + (z[0] is not b)):
            q.probe(ids[o], x[o], olo, ohi)
        want = np.sort(np.linalg.norm(x[b[:5], None] - x[None], axis=2), axis=1)[:, 1:4]
        assert np.allclose(q.dist[:5], want)
    assert sum(cells) < 1500 * len(x)
