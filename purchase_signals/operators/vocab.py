"""Category vocabulary (A19): the distinct values behind the one-hot columns,
fitted once and reused so that feature columns never depend on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categorical import age_group, user_type


def fit_vocabulary(log: DataFrame) -> DataFrame:
    """Long form (column_name, value): distinct non-null categories.

    Each row contributes four (column, value) pairs; the distinct is
    combined map-side, so the shuffle carries at most one row per category
    and task."""
    pairs = log.select(F.explode(F.array(
        F.struct(F.lit("region").alias("column_name"), F.col("region").alias("value")),
        F.struct(F.lit("acquisition_channel").alias("column_name"), F.col("acquisition_channel").alias("value")),
        F.struct(F.lit("age_group").alias("column_name"), age_group("user_segment").alias("value")),
        F.struct(F.lit("user_type").alias("column_name"), user_type("user_segment").alias("value")),
    )).alias("p")).select("p.*")
    return pairs.where(F.col("value").isNotNull()).distinct()


def vocabulary_dict(vocab: DataFrame) -> dict[str, list[str]]:
    """A fitted vocabulary as column -> values. It becomes the feature
    columns, so it has one row per feature column of the model."""
    out: dict[str, list[str]] = {}
    for r in vocab.orderBy("column_name", "value").collect():
        out.setdefault(r["column_name"], []).append(r["value"])
    return out
