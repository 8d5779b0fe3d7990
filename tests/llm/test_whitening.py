import duckdb
import numpy as np
import pytest

from purchase_signals.llm import whitening as W
from purchase_signals.llm.queries import QUERIES


def exact(rows):
    """x, n, S, eigenvalues and eigenvectors by plain numpy on the usable rows."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in good], object)
    n, s = len(x), x.sum(0)
    centred = (x - np.array([a / n for a in s])).astype(float)
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in good], x, n, s, centred, e[::-1], vectors[:, ::-1].T


def check(got, rows, k=32):
    ids, x, n, s, centred, e, vectors = exact(rows)
    k = min(k, int((e > 1e-12 * e[0]).sum()))
    assert len(got) == n * k
    by = {}
    for r in got:
        assert (r.n, r.component) == (n, r.component) and 1 <= r.component <= k
        by.setdefault(r.vec_id, {})[r.component] = r
    dev = {i: sum((n * a - b) ** 2 for a, b in zip(row, s)) for i, row in zip(ids, x)}
    assert all(r.deviation == dev[r.vec_id] for r in got)
    w = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in ids])
    want = centred @ vectors[:k].T / np.sqrt(e[:k])
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-6
    share = np.array([by[ids[0]][c].explained for c in range(1, k + 1)])
    assert np.allclose(share, e[:k] / e.clip(0).sum(), rtol=1e-8)
    real = np.abs(np.cov(w.T, bias=True).reshape(k, k) - np.eye(k)).max()
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and max(errors) <= 1e-8 and abs(max(errors) - real) < 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_eigenvectors(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}/embeddings.parquet'").fetchall()
    check(QUERIES["op13_whitening"](spark, path).collect(), rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, b"") for i, v in rows], "vec_id long, embedding array<double>, n int, x binary")


def test_steps_stop_early_on_wide_vectors(spark, monkeypatch):
    """Few strong directions in 90: fewer steps than dimensions give the first two."""
    rnd = np.random.default_rng(2)
    base = rnd.standard_normal((3, 90))
    rows = [(i, (rnd.standard_normal(3) * [900, 300, 100] @ base + rnd.standard_normal(90)).tolist()) for i in range(300)]
    steps, plain = [], W.product
    monkeypatch.setattr(W, "product", lambda t, p: steps.append(1) or plain(t, p))
    check(W.whiten(frame(spark, rows), k=2).collect(), rows, 2)
    assert len(steps) < 30


def test_edge_rows(spark):
    """Vectors that take no part, repeated and null ids, another width, clashing names."""
    rnd = np.random.default_rng(3)
    good = [(i, (rnd.standard_normal(5) * 50).tolist()) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0, 2.0]),
           (106, [1e300] * 5)]
    check(W.whiten(frame(spark, good + bad)).collect(), good)
    twice = W.whiten(frame(spark, [*good, good[3], (None, good[4][1])])).collect()
    assert {r.n for r in twice} == {22} and len(twice) == 22 * 5
    assert W.whiten(frame(spark, bad[:4])).collect() == []
    assert W.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect() == []
    assert W.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert W.whiten(frame(spark, [])).collect() == []


def test_dependent_dimensions_and_equal_deviations(spark):
    """Rank 2 in 4 dimensions; then two dimensions of equal deviation."""
    rnd = np.random.default_rng(4)
    two = rnd.integers(-40, 40, (30, 2)).astype(float)
    rows = [(i, [a, b, a + b, a - b]) for i, (a, b) in enumerate(two.tolist())]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-6
    cross = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, -1.0, 0.0]), (4, [0.0, 0.0, 1.0]), (5, [0.0, 0.0, -1.0])]
    got = W.whiten(frame(spark, cross)).collect()
    assert {r.component for r in got} == {1, 2, 3} and max(r.identity_error for r in got) < 1e-6


def test_deviation_beyond_64_bits():
    x = np.array([[3, 4], [2 ** 40, 1]], np.int64)
    assert W.deviations(x, 2 ** 21, np.array([0, 0])) == [25 * 2 ** 42, None]
    assert W.deviations(x[:1], 2, np.array([1, 1])) == [(6 - 1) ** 2 + (8 - 1) ** 2]
