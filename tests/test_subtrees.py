"""Forests below the top that MLlib grows (operators/subtrees.py)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from purchase_signals.operators import forest
from purchase_signals.operators import model as ML
from purchase_signals.operators import subtrees as S


@pytest.fixture(scope="module")
def rows(spark):
    # distinct rows whose class is mostly noise, so that trees grow deep
    r = spark.range(700).select(*[((F.col("id") * k + F.col("id") % 13) % 701).cast("double").alias(f"f{k}") for k in (3, 17, 101, 211)],
                                (F.xxhash64("id") % 2 == 0).cast("int").alias("purchase_24h"))
    return r.withColumn("f5", (F.col("f3") > 300).cast("double"))


FEATURES = ["f3", "f17", "f101", "f211", "f5"]


def fit(spark, rows, group, **params):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return ML.train_forest(rows, FEATURES, params=ML.ForestParams(num_trees=6, **params)), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_passes_do_not_follow_the_depth(spark, rows):
    shallow, few = fit(spark, rows, "shallow", max_depth=5)
    deep, more = fit(spark, rows, "deep", max_depth=30)
    assert deep.stages[-1].totalNumNodes > 1.5 * shallow.stages[-1].totalNumNodes
    assert max(t.depth for t in deep.stages[-1].trees) > 8 >= 5 >= max(t.depth for t in shallow.stages[-1].trees)
    assert more <= few + 3


def test_forest_is_whole_and_repeatable(spark, rows):
    model, _ = fit(spark, rows, "one", max_depth=30)
    nodes = forest.node_table(spark, model).collect()
    again, _ = fit(spark, rows.repartition(3), "two", max_depth=30)
    plain = lambda ns: sorted((n.tree, n.node, n.left_child, n.feature, n.threshold, tuple(n.weights)) for n in ns if n.left_child is not None)
    assert plain(nodes) == plain(forest.node_table(spark, again).collect())
    at = {(n.tree, n.node): n for n in nodes}
    for n in nodes:
        if n.left_child is not None:
            assert at[n.tree, n.left_child] and at[n.tree, n.right_child] and n.gain > 0
    # a bag holds about 63 % of the rows, so trees of pure leaves know most of them
    pred = ML.predict(model, rows, FEATURES, ["purchase_24h"])
    assert pred.where("prediction = purchase_24h").count() > 0.85 * 700
    assert model.stages[-1].getMaxDepth() == 30 and "_leaves" not in model.transform(ML.prepare_for_fit(rows, FEATURES)).columns


def test_small_nodes_are_not_split(spark, rows):
    model, _ = fit(spark, rows, "least", max_depth=30, min_instances_per_node=40)
    assert max(t.depth for t in model.stages[-1].trees) < 15


def test_split_is_the_best_of_all():
    rng = np.random.default_rng(5)
    x, y, n = rng.integers(0, 9, (80, 3)).astype(np.uint8), rng.integers(0, 2, 80), rng.integers(1, 4, 80)
    at, weight = np.repeat([0, 1], 40), np.array([0.7, 1.9])
    counts = np.stack([np.bincount(y[at == i], n[at == i], 2) for i in (0, 1)]).astype(np.int64)
    gain, feature, cut, left = S.best_splits(x, y, n, at, counts, weight, np.array([[0, 1, 2]] * 2), 9, 1)
    for i in (0, 1):
        def of(rows):
            w = np.bincount(y[rows], n[rows], 2) * weight
            return w.sum(), 1 - (w ** 2).sum() / max(w.sum(), 1e-9) ** 2

        here = np.flatnonzero(at == i)
        tries = []
        for f in range(3):
            for c in range(8):
                a, b = here[x[here, f] <= c], here[x[here, f] > c]
                if len(a) and len(b):
                    (wa, ga), (wb, gb), (w, g) = of(a), of(b), of(here)
                    tries.append(g - wa / w * ga - wb / w * gb)
        assert abs(gain[i] - max(tries)) < 1e-12
        a = here[x[here, feature[i]] <= cut[i]]
        assert left[i].tolist() == np.bincount(y[a], n[a], 2).tolist()
