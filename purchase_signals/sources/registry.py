"""Model registry on files (M9, M13, S13): append-only tables under a store
root, models saved with MLlib's writer.

    models/          one row per trained model (metrics map, feature list, path)
    promotions/      one row per promotion with the model's score; the active model is the latest one
    model_store/<v>/ PipelineModel files
    scaler/model_version=<v>/  scaler table of that model
    model_vocabulary/model_version=<v>/  categories behind its one-hot columns
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators.decisions import Production, promotions
from .files import read_or_empty
from .vocabulary import write_model_vocabulary

MODELS_SCHEMA = T.StructType([
    T.StructField("model_version", T.StringType()),
    T.StructField("trained_at", T.TimestampNTZType()),
    T.StructField("data_version", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_path", T.StringType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("scaled_features", T.ArrayType(T.StringType())),
])
PROMOTIONS_SCHEMA = T.StructType([
    T.StructField("model_version", T.StringType()),
    T.StructField("promoted_at", T.TimestampNTZType()),
    T.StructField("trained_at", T.TimestampNTZType()),
    T.StructField("score", T.DoubleType()),
])


def register_model(spark: SparkSession, root: str, model: PipelineModel, version: str, data_version: str,
                   metrics: dict[str, float], features: list[str], scaled: list[str], scaler: DataFrame,
                   trained_at: dt.datetime | None = None, vocab: DataFrame | None = None) -> None:
    """Save the model, its scaler and its vocabulary, then append its metadata row
    (the row is written last, so a registered model always has its files)."""
    path = os.path.join(root, "model_store", version)
    model.write().overwrite().save(path)
    scaler.withColumn("model_version", F.lit(version)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("model_version") \
        .parquet(os.path.join(root, "scaler"))
    if vocab is not None:
        write_model_vocabulary(vocab, root, version)
    row = [(version, trained_at or dt.datetime.now(), data_version, {k: float(v) for k, v in metrics.items()},
            path, list(features), list(scaled))]
    spark.createDataFrame(row, MODELS_SCHEMA).write.mode("append").parquet(os.path.join(root, "models"))


def read_models(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, os.path.join(root, "models"), MODELS_SCHEMA)


def active_version(spark: SparkSession, root: str) -> DataFrame:
    """One row (model_version, promoted_at, trained_at, score) or none."""
    path = os.path.join(root, "promotions")
    p = read_or_empty(spark, path, PROMOTIONS_SCHEMA)
    return p.select(F.max_by(F.struct(*PROMOTIONS_SCHEMA.names), "promoted_at").alias("a")) \
        .where(F.col("a").isNotNull()).select("a.*")


def production(spark: SparkSession, root: str, metric: str = "test_f1_score") -> Production:
    """The state that promotions go on from: read from the latest promotion; the
    model's row is asked only for a promotion stored without its score."""
    act = active_version(spark, root).first()
    if act is None:
        return Production()
    if act.score is None or act.trained_at is None:
        act = candidates(spark, root, metric).where(F.col("model_version") == act.model_version) \
            .select("model_version", "trained_at", F.col("test_f1").alias("score")).first() or act
    return Production(act.score or 0.0, act.model_version, act.trained_at)


def candidates(spark: SparkSession, root: str, metric: str = "test_f1_score") -> DataFrame:
    """The registered models as candidates for promotion."""
    return read_models(spark, root).select("model_version", "trained_at", F.try_element_at("metrics", F.lit(metric)).alias("test_f1"))


def _write_promotions(spark: SparkSession, root: str, found: list[Production]) -> None:
    now = dt.datetime.now()
    rows = [(p.model_version, now + dt.timedelta(microseconds=i), p.trained_at, p.score) for i, p in enumerate(found)]
    spark.createDataFrame(rows, PROMOTIONS_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(root, "promotions"))


def promote_if_better(spark: SparkSession, root: str, version: str,
                      metric: str = "test_f1_score", min_gain: float = C.MIN_F1_IMPROVEMENT) -> bool:
    """Promote ``version`` when its metric beats the active model's by more
    than ``min_gain`` (no active model: baseline 0.0) (M8, M9). Promotion
    appends a row; the previous model stops being active implicitly."""
    cand = candidates(spark, root, metric).where(F.col("model_version") == version).first()
    if cand is None:
        raise ValueError(f"unknown model {version}")
    new = cand.test_f1 if cand.test_f1 is not None else 0.0
    if new - production(spark, root, metric).score > min_gain:
        _write_promotions(spark, root, [Production(new, version, cand.trained_at)])
        return True
    return False


def promote_since(spark: SparkSession, root: str, metric: str = "test_f1_score",
                  min_gain: float = C.MIN_F1_IMPROVEMENT) -> list[str]:
    """Promote among the models trained behind the production model, in order of
    training (M8, M9), and give the versions promoted. It goes on from the stored
    state, so older models are filtered out in the scan; a second call promotes
    nothing more."""
    found = promotions(candidates(spark, root, metric), min_gain, production(spark, root, metric))
    if found:
        _write_promotions(spark, root, found)
    return [p.model_version for p in found]


def load_active_model(spark: SparkSession, root: str):
    """(model, feature names, scaler table, scaled names, version) of the
    active model; error when none is active or its feature list is missing."""
    act = active_version(spark, root).first()
    if act is None:
        raise LookupError("no active model")
    meta = spark.read.parquet(os.path.join(root, "models")).where(F.col("model_version") == act.model_version).first()
    if meta is None or not meta.feature_names:
        raise LookupError(f"model {act.model_version} has no feature list")
    scaler = spark.read.parquet(os.path.join(root, "scaler")).where(F.col("model_version") == act.model_version) \
        .drop("model_version")
    return (PipelineModel.load(meta.model_path), list(meta.feature_names), scaler,
            list(meta.scaled_features or []), act.model_version)
