"""Forests that stay in files: whole training rows, scores chunk by chunk (operators/walk.py)."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from purchase_signals.operators import forest
from purchase_signals.operators import model as ML
from purchase_signals.operators import subtrees as S
from purchase_signals.operators import walk as W

FEATURES = ["f3", "f17", "f101", "f5"]
PARAMS = ML.ForestParams(num_trees=7, max_depth=30)


@pytest.fixture(scope="module")
def rows(spark):
    r = spark.range(900).select("id", *[((F.col("id") * k + F.col("id") % 13) % 701).cast("double").alias(f"f{k}") for k in (3, 17, 101)],
                                (F.xxhash64("id") % 3 == 0).cast("int").alias("purchase_24h"))
    return r.withColumn("f5", (F.col("f3") > 300).cast("double"))


def same_as_mllib(model, rows):
    got = {r.id: r for r in ML.predict(model, rows, FEATURES, ["id"]).collect()}
    want = {r.id: r for r in ML.predict(model.loaded, rows, FEATURES, ["id"]).collect()}
    assert got.keys() == want.keys() and len(got) == rows.count()
    assert all(math.isclose(got[i].probability, want[i].probability, abs_tol=1e-12) for i in got)
    assert all(got[i].prediction == want[i].prediction for i in got if abs(want[i].probability - 0.5) > 1e-9)


def test_every_row_is_fitted(spark):
    n = 2_100_000
    data = spark.range(n).select((F.col("id") % 1000).cast("double").alias("f"), (F.col("id") % 2).cast("int").alias("purchase_24h"))
    model = ML.train_forest(data, ["f"], params=ML.ForestParams(num_trees=1, max_depth=2))
    assert sum(forest.node_table(spark, model).where("node = 0").first().weights) == pytest.approx(n, rel=0.01)  # a bag has about as many rows


def test_nothing_loads_the_forest_to_the_driver(spark, rows, monkeypatch):
    def load(*_):
        raise AssertionError("the forest was loaded")

    monkeypatch.setattr(RandomForestClassificationModel, "load", load)
    monkeypatch.setattr(PipelineModel, "load", load)
    model = ML.train_forest(rows, FEATURES, params=PARAMS)
    assert ML.predict(model, rows, FEATURES, ["id"]).count() == 900
    assert sum(r.importance for r in ML.importances(spark, model, FEATURES, top=None).collect()) == pytest.approx(1.0)
    folds = ML.cross_validate(spark, rows, FEATURES, ["id"], k=2, params=PARAMS)
    assert {r.fold for r in folds.collect()} == {"0", "1", "mean", "std"}


@pytest.mark.parametrize(("nodes", "block"), [(2_000_000, 250_000), (500, 100), (40, 100)])
def test_chunks_vote_like_the_whole_forest(spark, rows, monkeypatch, nodes, block):
    model = ML.train_forest(rows, FEATURES, params=PARAMS)
    monkeypatch.setattr(W, "CHUNK_NODES", nodes)
    monkeypatch.setattr(W, "BLOCK_ROWS", block)
    same_as_mllib(model, rows.unionByName(rows.withColumn("id", F.col("id") + 900)))


def test_large_groups_are_split_first(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "GROUP_ROWS", 60)
    monkeypatch.setattr(S, "PASS_NODES", 5)
    model = ML.train_forest(rows, FEATURES, params=PARAMS)
    nodes = {(n.tree, n.node): n for n in forest.node_table(spark, model).collect()}
    inner = [n for n in nodes.values() if n.left_child is not None]
    assert all((n.tree, c) in nodes and n.gain > 0 for n in inner for c in (n.left_child, n.right_child))
    largest = model.subtrees.select(F.max(F.length("counts") / 16)).first()[0]
    assert largest <= 2 * 60 and len(model.stats) > 8 * 7
    same_as_mllib(model, rows)
    pred = ML.predict(model, rows, FEATURES, ["purchase_24h"])
    assert pred.where("prediction = purchase_24h").count() > 0.85 * 900


def test_split_of_summed_counts_is_the_best(spark, rows, monkeypatch):
    """A node split by the tasks' sums goes where the group itself would split it."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(5)
    x, y, n = rng.integers(0, 9, (80, 3)).astype(np.uint8), rng.integers(0, 2, 80), rng.integers(1, 4, 80)
    weight, tried = np.array([0.7, 1.9]), np.array([[2, 0, 1]])
    counts = np.bincount(y, n, 2).astype(np.int64)[None]
    gain, feature, cut, left = S.best_splits(x, y, n, np.zeros(80, np.int64), counts, weight, tried, 9, 1)
    halves = [np.stack([np.bincount(x[s, f].astype(np.int64) * 2 + y[s], n[s], 18).astype(np.int64) for f in tried[0]]) for s in (slice(30), slice(30, 80))]
    got = S.chooser(weight, tried, 9, 1)((pa.scalar(0),), pa.table({"at": [0, 0], "sums": [h.tobytes() for h in halves]})).to_pylist()[0]
    assert (got["feature"], got["cut"], got["lefts"], got["counts"]) == (feature[0], cut[0], left[0].tolist(), counts[0].tolist())
    assert abs(got["gain"] - gain[0]) < 1e-12


def test_saved_forest_is_whole(spark, rows, tmp_path):
    model = ML.train_forest(rows, FEATURES, params=PARAMS)
    model.write().save(f"{tmp_path}/m")
    model.write().overwrite().save(f"{tmp_path}/m")
    back = PipelineModel.load(f"{tmp_path}/m")
    assert back.stages[-1].totalNumNodes == model.stages[-1].totalNumNodes
    same = [sorted(r.probability for r in ML.predict(m, rows, FEATURES, ["id"]).collect()) for m in (back, model)]
    assert same[0] == pytest.approx(same[1])


def test_null_is_refused(spark, rows):
    model = ML.train_forest(rows, FEATURES, params=PARAMS)
    with pytest.raises(Exception, match="null or NaN"):
        ML.predict(model, rows.withColumn("f17", F.when(F.col("id") != 5, F.col("f17"))), FEATURES, ["id"]).collect()
