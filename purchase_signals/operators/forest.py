"""A fitted forest as a table of nodes (M5, M6, T2): scores and importances as joins
and aggregates over it, in a form that any SQL engine can read.

    tree, node, left_child, right_child, feature, threshold, gain, weights

Leaves have no children (null) and ``weights`` holds the weight of each class in
a node. ``walk`` and MLlib's own transform are the ways to score many rows; the
table says what they compute.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stored
from .walk import StoredForest


def node_table(spark: SparkSession, model: PipelineModel | StoredForest) -> DataFrame:
    """The nodes of the model's forest, one row each, read from its saved form in
    the shared folder. Every split is by a threshold: a model column is a number."""
    if isinstance(model, StoredForest):
        data = model.data
    else:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores/forest-{uuid.uuid4().hex}"
        model.stages[-1].write().save(path)
        data = f"{path}/data"
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0

    def of_split(c):
        return F.when(inner, c)

    rows = spark.read.parquet(data).select(
        F.col("treeID").cast("int").alias("tree"), n["id"].alias("node"), of_split(n["leftChild"]).alias("left_child"),
        of_split(n["rightChild"]).alias("right_child"), of_split(n["split"]["featureIndex"]).alias("feature"),
        of_split(n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"), of_split(n["gain"]).alias("gain"),
        n["impurityStats"].alias("weights"), of_split(n["split"]["numCategories"]).alias("categories"))
    if not rows.where(F.col("categories") >= 0).isEmpty():
        raise ValueError("a split by categories is not a threshold")
    return stored(rows.drop("categories"), "nodes")


def score(nodes: DataFrame, rows: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``keep``, predicted class and P(class 1) of every row, level by level: each
    row stands at one node of each tree and steps to a child by a join on (tree,
    node). A class's probability is the mean of its shares in the leaves; at equal
    ones class 0 is predicted. Rows are told apart by number, so equal rows stay
    rows of their own; a null or NaN value goes right, as it is not below a threshold."""
    values = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features])
    x = stored(rows.select(F.struct(*keep).alias("kept"), values.alias("x")), "rows").withColumn("row", F.monotonically_increasing_id())
    roots = nodes.where("node = 0").select("tree")
    # the trees, one row each, are dealt to every row as a list
    trees = roots.select(F.sort_array(F.collect_list("tree"))).scalar()
    at = x.select("row", "x", F.explode(trees).alias("tree"), F.lit(0).alias("node"))
    steps = nodes.select("tree", "node", "left_child", "right_child", "feature", "threshold")
    down = F.when(F.col("left_child").isNull(), F.col("node")).when(
        F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left_child")).otherwise(F.col("right_child"))
    for _ in range(depth(nodes)):
        at = at.join(steps, ["tree", "node"]).select("row", "x", "tree", down.alias("node"))
    w = F.col("weights")
    share = F.try_divide(F.get(w, F.lit(1)), F.get(w, F.lit(0)) + F.get(w, F.lit(1)))
    p = at.join(nodes.select("tree", "node", "weights"), ["tree", "node"]).groupBy("row").agg(F.avg(share).alias("probability"))
    return x.join(p, "row").select("kept.*", (F.col("probability") > 0.5).cast("int").alias("prediction"), "probability")


def depth(nodes: DataFrame) -> int:
    """Levels below the root: passes of one join, each over the nodes of a level."""
    level, found = nodes.where("node = 0").select("tree", "node"), 0
    while True:
        inner = level.join(nodes.where("left_child IS NOT NULL"), ["tree", "node"])
        level = stored(inner.select("tree", F.explode(F.array("left_child", "right_child")).alias("node")), "level")
        if level.isEmpty():
            return found
        found += 1


def importances(nodes: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance) of every model column (M6, T2): the gains of its
    splits by the weight of their nodes, shares of each tree, averaged over the
    trees that split at all. Columns without a split have 0; all sum to 1."""
    weight = F.aggregate("weights", F.lit(0.0), lambda a, b: a + b)
    gains = nodes.where("left_child IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("g"))
    total = gains.groupBy("tree").agg(F.sum("g").alias("t"))
    share = gains.join(total, "tree").where("t > 0").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    whole = share.agg(F.sum("s")).scalar()
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "position int, name string")
    return names.join(share, F.col("position") == F.col("feature"), "left").select(
        F.col("name").alias("feature"), F.coalesce(F.col("s") / whole, F.lit(0.0)).alias("importance"))
