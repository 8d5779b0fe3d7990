"""Growing vocabulary of categories (A19), bound to feature versions and models.

    vocabulary/processing_version=<v>/     categories that version v saw first
    model_vocabulary/model_version=<m>/    the whole vocabulary a model was trained with

The vocabulary as of version v is the union over the committed versions up to v;
it only grows, so a column once there stays, false in rows of older versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators.merge import versions_up_to
from ..operators.vocab import fit_vocabulary, vocabulary_dict
from ..session import stored
from .files import overwrite_partition, read_or_empty, read_runs

SCHEMA = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("value", T.StringType()),
                       T.StructField("processing_version", T.StringType())])
MODEL_SCHEMA = T.StructType([*SCHEMA.fields[:2], T.StructField("model_version", T.StringType())])


def load_vocabulary(spark: SparkSession, root: str, version: str | None = None, without: str | None = None) -> DataFrame:
    """(column_name, value, processing_version) as of a committed version, the
    latest by default; ``without`` leaves out the version a retry writes again."""
    runs = read_runs(spark, root)
    if without is not None:
        runs = runs.where(F.col("processing_version") != F.lit(without))
    wanted = versions_up_to(runs, version).select("processing_version")
    return read_or_empty(spark, f"{root}/vocabulary", SCHEMA).join(wanted, "processing_version", "left_semi").select(*SCHEMA.names)


def grow(spark: SparkSession, root: str, version: str, rows: DataFrame) -> dict[str, list[str]]:
    """Write the categories of ``rows`` that no earlier version has as those of
    ``version``; gives the whole vocabulary, column -> values.

    It becomes the table's columns, so more than ``MAX_CATEGORIES`` is an error,
    raised before anything is written."""
    known = load_vocabulary(spark, root, without=version).select("column_name", "value")
    new = stored(fit_vocabulary(rows).join(known, ["column_name", "value"], "left_anti"), "categories")  # one pass over the rows
    both = known.unionByName(new)
    n = both.count()
    if n > C.MAX_CATEGORIES:
        raise ValueError(f"{n} categories, at most {C.MAX_CATEGORIES} can be columns")
    out = vocabulary_dict(both)
    overwrite_partition(new, f"{root}/vocabulary", "processing_version", version)
    return out


def write_model_vocabulary(vocab: DataFrame, root: str, model_version: str) -> None:
    overwrite_partition(vocab.select("column_name", "value"), f"{root}/model_vocabulary", "model_version", model_version)


def model_vocabulary(spark: SparkSession, root: str, model_version: str) -> dict[str, list[str]]:
    """The vocabulary a model was trained with; empty if none was written."""
    rows = read_or_empty(spark, f"{root}/model_vocabulary", MODEL_SCHEMA).where(F.col("model_version") == F.lit(model_version))
    return vocabulary_dict(rows)
