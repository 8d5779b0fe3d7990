"""Structured Streaming jobs (R1-R3): file sources, ``availableNow``
triggers, ``foreachBatch`` sinks keyed by batch id.

The checkpoint says which files were read; what of them was stored, featurized
or scored stands in the run rows, written last. A retried batch rewrites its
own partition and run row, and rows that a gate holds back wait in the store.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators import score as SC
from ..plans import runs
from ..session import stored
from ..sources import vocabulary
from ..sources.files import CSV_TIMESTAMP_FORMAT, RAW_LOG_SCHEMA


def _checkpoint(root: str, name: str) -> str:
    """A stream's progress lives with the store it writes (shared storage),
    so each store has its own streams and a restart resumes where it was."""
    return os.path.join(root, "_streams", name)


def _stream_id(spark: SparkSession, root: str, name: str) -> str:
    """Identity of a stream, from its checkpoint: a stream begun anew counts its
    batches from 0 again and must not replace what the former one wrote."""
    return spark.read.json(os.path.join(_checkpoint(root, name), "metadata")).first().id[:8]


def ingest_stream(spark: SparkSession, landing_dir: str, root: str, fmt: str = "csv",
                  min_batch: int = C.MIN_INGEST_BATCH, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """New landing files -> hash, anti-join against the store, append."""
    reader = spark.readStream.schema(RAW_LOG_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.format(fmt).load(landing_dir)

    def sink(batch: DataFrame, batch_id: int) -> None:
        runs.ingest_batch(spark, batch, root, f"stream_{_stream_id(spark, root, 'ingest')}_{batch_id:08d}", min_batch)

    return (src.writeStream.foreachBatch(sink).option("checkpointLocation", _checkpoint(root, "ingest"))
            .trigger(availableNow=True).start())


def featurize_stream(spark: SparkSession, root: str, min_batch: int = C.MIN_FEATURIZE_BATCH) -> StreamingQuery:
    """R2: rows appended to the raw store -> featurize -> merge -> new
    version per batch (version name carries the batch id)."""
    schema = T.StructType(RAW_LOG_SCHEMA.fields + [T.StructField("record_hash", T.StringType()),
                                                   T.StructField("ingest_run", T.StringType())])
    src = spark.readStream.schema(schema).parquet(os.path.join(root, "raw_log"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the batch says that rows arrived; what to do is read from the store,
        # so rows that a gate held back earlier are in it
        runs.featurize_increment(spark, root, f"stream_v{_stream_id(spark, root, 'featurize')}_{batch_id:08d}", None, min_batch)

    return (src.writeStream.foreachBatch(sink).option("checkpointLocation", _checkpoint(root, "featurize"))
            .trigger(availableNow=True).start())


def score_stream(spark: SparkSession, inbox_dir: str, root: str, model: PipelineModel, features: list[str],
                 scaler: DataFrame, scaled: list[str], model_version: str, vocab: dict[str, list[str]] | None = None) -> StreamingQuery:
    """Rows without a committed prediction -> serving features by the model's
    vocabulary (by default the one stored with ``model_version``) -> forest ->
    partition ``pred_<stream>_<batch id>`` with the input columns, then its run
    row. A retried batch replaces both."""
    schema = T.StructType(RAW_LOG_SCHEMA.fields + [T.StructField("predicted", T.BooleanType())])
    src = spark.readStream.schema(schema).parquet(inbox_dir)
    vocab = vocabulary.model_vocabulary(spark, root, model_version) if vocab is None else vocab
    active = runs.ActiveModel(model_version, model, features, scaler, scaled, vocab)

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = f"pred_{_stream_id(spark, root, 'score')}_{batch_id:08d}"
        pending = stored(SC.pending_copies(batch, runs.committed_predictions(spark, root, run)), "pending")
        runs.write_predictions(spark, root, active.scored(pending), run, model_version)

    return (src.writeStream.foreachBatch(sink).option("checkpointLocation", _checkpoint(root, "score"))
            .trigger(availableNow=True).start())
