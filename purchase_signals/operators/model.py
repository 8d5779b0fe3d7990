"""Random-forest training, cross-validation, scoring and importances with
Spark MLlib (M2, M3, M5, M6, T2, A17).

MLlib trains on partitions and aggregates split statistics across executors.
A deep forest stays in files and scores where its nodes are (``walk``). Nothing
here collects rows or, below the tops of the trees, nodes.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import stored
from . import forest, subtrees
from .metrics import binary_metrics, roc_auc
from .prepare import stratified_folds
from .walk import StoredForest


@dataclass
class ForestParams:
    num_trees: int = C.N_ESTIMATORS
    max_depth: int = 30          # MLlib's ceiling; the original grows unlimited trees
    min_instances_per_node: int = 1
    feature_subset: str = "sqrt"
    max_bins: int = 32
    seed: int = C.RANDOM_STATE
    # Forests that MLlib grows whole: keep each row's node id on the executors
    # instead of shipping the growing trees every level (checkpointed to the shared
    # checkpoint folder), and let one pass split more nodes at once.
    cache_node_ids: bool = True
    max_memory_mb: int = 1024


def with_class_weights(df: DataFrame, label: str = C.TARGET, weight_col: str = "class_weight") -> DataFrame:
    """Balanced weights n / (k * n_c) as a column (M4). The per-class counts
    come from one scalar subquery (a map with one entry per class), so the
    rows are projected where they are and never shuffled on the label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    by_class = counts.select(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("m"), F.sum("n").alias("n"))
    facts = by_class.select(F.struct("m", "n")).scalar()
    out = df.where(F.col(label).isNotNull()).withColumn("_classes", facts)
    weight = F.col("_classes")["n"] / (F.size(F.col("_classes")["m"]) * F.col("_classes")["m"][F.col(label)])
    return out.withColumn(weight_col, weight).drop("_classes")


def forest_pipeline(features: list[str], label: str = C.TARGET, weight_col: str | None = "class_weight",
                    params: ForestParams | None = None) -> Pipeline:
    p = params or ForestParams()
    assembler = VectorAssembler(inputCols=features, outputCol="features_vec", handleInvalid="error")
    rf = RandomForestClassifier(
        featuresCol="features_vec", labelCol=label, numTrees=p.num_trees, maxDepth=p.max_depth,
        minInstancesPerNode=p.min_instances_per_node, featureSubsetStrategy=p.feature_subset,
        maxBins=p.max_bins, seed=p.seed, cacheNodeIds=p.cache_node_ids, maxMemoryInMB=p.max_memory_mb,
        checkpointInterval=10, **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[assembler, rf])


def prepare_for_fit(df: DataFrame, features: list[str], label: str = C.TARGET) -> DataFrame:
    """Booleans and integers to double, label to double (MLlib inputs)."""
    return df.withColumns({f: F.col(f).cast("double") for f in features} | {label: F.col(label).cast("double")})


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt by a hash of their values to a number of partitions that depends
    on the number of rows alone, and sorted by it there. MLlib draws its bags
    partition by partition, so the forest depends on the rows alone, not on cores
    or on how the input was laid out."""
    partitions = partitions or max(C.FIT_PARTITIONS, math.ceil(df.count() / C.FIT_PARTITION_ROWS))
    return (df.withColumn("_row", F.xxhash64(*df.columns)).repartition(partitions, "_row")
            .sortWithinPartitions("_row", *df.columns).drop("_row"))


def train_forest(train: DataFrame, features: list[str], label: str = C.TARGET,
                 params: ForestParams | None = None) -> PipelineModel | StoredForest:
    """Fit the forest with balanced class weights to every labelled row (M2): MLlib
    grows the top of each tree, ``subtrees`` what lies deeper."""
    p = params or ForestParams()
    data = spread(with_class_weights(prepare_for_fit(train, features, label).select(*features, label), label))
    if p.max_depth <= subtrees.TOP_DEPTH:
        return forest_pipeline(features, label, "class_weight", p).fit(data)
    # rows get their numbers in the order of the spread, which depends on their values alone
    rows = stored(data.withColumn(subtrees.ROW, F.monotonically_increasing_id()), "fit")
    # a top is small enough to be shipped every level
    shallow = replace(p, max_depth=subtrees.TOP_DEPTH, cache_node_ids=False)
    top = forest_pipeline(features, label, "class_weight", shallow).fit(spread(rows.drop(subtrees.ROW)))
    return subtrees.finished(top, rows, features, label, "class_weight", p)


def predict(model: PipelineModel | StoredForest, df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Predicted class and P(class 1) (M5)."""
    data = (prepare_for_fit(df, features, C.TARGET) if C.TARGET in df.columns
            else df.withColumns({f: F.col(f).cast("double") for f in features}))
    if isinstance(model, StoredForest):
        return model.predict(data, keep)
    return model.transform(data).select(*keep, F.col("prediction").cast("int").alias("prediction"),
                                        vector_to_array("probability")[1].alias("probability"))


def evaluate(pred: DataFrame, label: str = C.TARGET) -> DataFrame:
    """Test metrics row: accuracy, precision, recall, f1, roc_auc. The
    predictions are written once first: each metric job would otherwise
    re-run the forest (and re-ship it to the executors)."""
    pred = stored(pred, "predictions")
    b = binary_metrics(pred, label, "prediction")
    auc = roc_auc(pred, label, "probability").select("roc_auc").scalar()
    return b.withColumn("roc_auc", auc)


def importances(spark: SparkSession, model: PipelineModel | StoredForest, features: list[str], top: int | None = C.TOP_IMPORTANCES) -> DataFrame:
    """Feature importances (M6, T2): one row per model feature (bounded by the
    model width, not the data), aggregated over the nodes of a stored forest."""
    if isinstance(model, StoredForest):
        df = forest.importances(forest.node_table(spark, model), features)
    else:
        vec = model.stages[-1].featureImportances.toArray().tolist()
        df = spark.createDataFrame(list(zip(features, [float(v) for v in vec])), "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), "feature")
    return df.limit(top) if top else df


def cross_validate(spark: SparkSession, train: DataFrame, features: list[str], key_cols: list[str],
                   label: str = C.TARGET, k: int = C.CV_FOLDS, params: ForestParams | None = None,
                   parallelism: int = C.CV_PARALLELISM) -> DataFrame:
    """k-fold CV over stratified folds, weighted F1 per fold (M3), mean /
    population std (A17) as extra rows. Each fit is a distributed MLlib job;
    up to ``parallelism`` folds are submitted at a time, so their jobs share
    the cluster and the driver plans for no more of them at once."""
    # written once: every fold's passes read files, not the lineage or a cache
    data = stored(stratified_folds(train, key_cols, k, label), "folds")
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")

    def run(fold: int) -> tuple[str, float]:
        fit_part = data.where(F.col("fold") != fold)
        held = data.where(F.col("fold") == fold)
        model = train_forest(fit_part, features, label, params)
        scored = predict(model, prepare_for_fit(held, features, label), features, [label])
        return str(fold), float(evaluator.evaluate(scored.select(label, F.col("prediction").cast("double"))))

    with ThreadPoolExecutor(max_workers=max(1, min(k, parallelism))) as pool:
        rows = list(pool.map(run, range(k)))
    folds = spark.createDataFrame(rows, "fold string, weighted_f1 double")
    summary = folds.agg(F.avg("weighted_f1").alias("m"), F.stddev_pop("weighted_f1").alias("s"))
    return folds.unionByName(summary.select(F.lit("mean").alias("fold"), F.col("m").alias("weighted_f1"))) \
        .unionByName(summary.select(F.lit("std").alias("fold"), F.col("s").alias("weighted_f1")))
