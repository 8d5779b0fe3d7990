import itertools

import duckdb
import numpy as np

from purchase_signals.llm import ann
from purchase_signals.llm.queries import QUERIES


def brute(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % every == 0:
            d = ann.distances(np.array(v, float), x)
            out[i] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != i][:k]
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in out:
        out[q].sort()
        assert [r[0] for r in out[q]] == list(range(1, len(out[q]) + 1))
    return {q: [r[1:] for r in v] for q, v in out.items()}


def test_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    want, got = brute(rows, 10, 100), collected(QUERIES["op10_nearest"](spark, sf))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    vector = dict(rows)
    for q in got:
        for i, s in got[q]:
            assert abs(s - np.linalg.norm(np.array(vector[q], float) - np.array(vector[i], float))) < 1e-12


def test_copies_ties_and_invalid_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 2.5]), (101, [0.0, 0.0]), (102, None), (103, [nan, 1.0]), (104, [inf, 1.0]),
                                                  (105, [None, 1.0]), (106, []), (107, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")
    got = collected(ann.nearest(df))
    assert got == {0: [(i, 0.0) for i in range(1, 11)], 100: [(i, 0.5) for i in range(10)]}


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [900.0, 3.0]), (2, [-7.0, 1e6])], "vec_id long, embedding array<float>")
    got = collected(ann.nearest(df))
    assert [i for i, _ in got[0]] == [1, 2]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 0")).count() == 0


def test_probes_come_in_order_of_success():
    f = np.array([0.1, 0.45, 0.8])
    got = ann.perturbations(f, 12)
    cost = lambda d: sum((f[k] if x < 0 else 1 - f[k]) ** 2 for k, x in enumerate(d) if x)
    every = sorted(itertools.product((-1, 0, 1), repeat=3), key=cost)
    assert [round(cost(d), 9) for d in got] == [round(cost(d), 9) for d in every[:12]]
    assert len({tuple(d) for d in ann.perturbations(f, 27)}) == 27


def test_crowded_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "SPLIT", 20)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(600)]
    got = collected(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = brute(rows, 10, 100)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 60
