"""File sources and sinks.

Layout under a store root (shared storage on a cluster):

    raw_log/ingest_run=<id>/      appended by ingest (unique record_hash)
    features/processing_version=<v>/   rows added by version v (its delta)
    pending_log/ingest_run=<id>/  batches that the gate held back, joined to the next one
    log_keys/, feature_keys/      key indexes by run and hash prefix (keyindex)
    vocabulary/processing_version=<v>/  categories first seen by version v
    ingest_runs/run=<id>/, pending_runs/run=<id>/, feature_runs/run=<v>/, prediction_runs/run=<id>/
                                  one row per run; written last = commit
    predictions/prediction_id=<id>/
    models/, scaler/              model metadata and scaler tables

Writers never overwrite a path they read: a new version goes to a new
partition directory, and readers select versions through the run table. The
table of version v is the union of the deltas of every version committed up
to v (existing rows win, so older rows never change), so a run writes only
its new rows instead of rewriting the whole table.
"""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_LOG_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("first_visit_date", T.StringType()),
    T.StructField("purchase_date", T.StringType()),
    T.StructField("screen_list", T.StringType()),
    T.StructField("session_count", T.LongType()),
    T.StructField("total_screens_viewed", T.LongType()),
    T.StructField("used_search_feature", T.IntegerType()),
    T.StructField("wrote_review", T.IntegerType()),
    T.StructField("added_to_wishlist", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("platform", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("acquisition_channel", T.StringType()),
    T.StructField("user_segment", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("made_purchase", T.IntegerType()),
    T.StructField("log_ts", T.TimestampNTZType()),
])


# Text form of timestamps in CSV files: 'YYYY-mm-dd HH:MM:SS' with optional
# fraction (microseconds are kept).
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
CSV_TIMESTAMP_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_LOG_SCHEMA) -> DataFrame:
    """CSV scan with a header and a declared schema (S1); no inference pass."""
    return (spark.read.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
            .schema(schema).csv(path))


def export_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV with a header, no index column."""
    df.write.mode("overwrite").option("header", True) \
        .option("timestampNTZFormat", CSV_TIMESTAMP_WRITE_FORMAT).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Small artifact tables (confusion matrix, importances, scaler) as JSON
    records (S13)."""
    df.write.mode("overwrite").json(path)


STORED_LOG_SCHEMA = T.StructType([*RAW_LOG_SCHEMA.fields, T.StructField("record_hash", T.StringType()),
                                  T.StructField("ingest_run", T.StringType())])
INGEST_RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("last_processed_timestamp", T.TimestampNTZType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("sample_hashes", T.ArrayType(T.StringType())),
    T.StructField("consumed_pending", T.ArrayType(T.StringType())),
    T.StructField("run", T.StringType()),
])
FEATURE_RUNS_SCHEMA = T.StructType([
    T.StructField("processing_version", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("new_record_count", T.LongType()),
    T.StructField("id_count", T.LongType()),
    T.StructField("purchase_rate", T.DoubleType()),
    T.StructField("feature_count", T.LongType()),
    T.StructField("last_processed_timestamp", T.TimestampNTZType()),
    T.StructField("domain", T.StringType()),
    T.StructField("ingest_runs", T.ArrayType(T.StringType())),
    T.StructField("label_sum", T.LongType()),
    T.StructField("label_count", T.LongType()),
    T.StructField("columns_json", T.StringType()),
    T.StructField("run", T.StringType()),
])
PENDING_RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("run", T.StringType()),
])
PREDICTION_RUNS_SCHEMA = T.StructType([
    T.StructField("prediction_id", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("positive_rate", T.DoubleType()),
    T.StructField("run", T.StringType()),
])
RUN_SCHEMAS = {"ingest_runs": INGEST_RUNS_SCHEMA, "feature_runs": FEATURE_RUNS_SCHEMA, "pending_runs": PENDING_RUNS_SCHEMA,
               "prediction_runs": PREDICTION_RUNS_SCHEMA}


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or no rows if nothing has been written there yet.
    Any other fault (storage, permission) is raised: taking it for an empty
    store would ingest everything a second time."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def overwrite_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Write ``df`` as the one partition ``column=value`` of a table: a retry
    replaces its own files and touches no others."""
    (df.withColumn(column, F.lit(value)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED_LOG_SCHEMA).parquet(os.path.join(root, "raw_log")).drop("ingest_run")


def write_feature_version(features: DataFrame, root: str, version: str) -> DataFrame:
    """Write the rows a version adds as its own directory (S7) and give them back
    as they lie there. Dynamic partition overwrite touches only this version, so
    a retry of the same version replaces its own files and nothing else."""
    path = os.path.join(root, "features")
    (features.withColumn("processing_version", F.lit(version)).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("processing_version").parquet(path))
    schema = T.StructType([*features.drop("processing_version").schema.fields, T.StructField("processing_version", T.StringType())])
    return read_or_empty(features.sparkSession, path, schema).where(F.col("processing_version") == F.lit(version)).drop("processing_version")


def write_run(run: DataFrame, root: str, run_id: str, table: str = "feature_runs") -> None:
    """The run row of ``run_id`` (S11), written after the data it describes,
    so it is the commit point readers rely on. A run has one row: a retry
    replaces it."""
    overwrite_partition(run, os.path.join(root, table), "run", run_id)


def read_runs(spark: SparkSession, root: str, table: str = "feature_runs") -> DataFrame:
    """Run rows, none before the first run."""
    return read_or_empty(spark, os.path.join(root, table), RUN_SCHEMAS[table]).drop("run")


def feature_schema(runs: DataFrame) -> T.StructType | None:
    """Columns of all versions of a run table, in order of appearance (versions
    gain one-hot columns as categories appear). Read from the run rows, one
    entry for each change of columns, so no file footers are merged."""
    kinds = runs.where(F.col("columns_json").isNotNull()).groupBy("columns_json").agg(F.min("processed_at").alias("at")).orderBy("at", "columns_json").collect()
    out: dict[str, T.StructField] = {}
    for r in kinds:
        for f in T.StructType.fromJson(json.loads(r.columns_json)).fields:
            out.setdefault(f.name, f)
    return T.StructType(list(out.values())) if out else None


def load_features(spark: SparkSession, root: str, version: str | None = None, without: str | None = None) -> DataFrame | None:
    """The table as of one version, the latest committed one by default
    (S4); None when nothing is committed. Only committed versions are read
    (an uncommitted directory is ignored), every row is stamped with the
    requested version, and the version filter prunes partitions. One-hot columns
    that a later version brought are false in older rows. ``without`` leaves out
    one version: the one a retried run is about to write again."""
    from ..operators.merge import load_version, versions_up_to

    runs = read_runs(spark, root)
    if without is not None:
        runs = runs.where(F.col("processing_version") != F.lit(without))
    if runs.isEmpty():
        return None
    schema = feature_schema(runs.join(versions_up_to(runs, version).select("processing_version"), "processing_version", "left_semi"))
    path = os.path.join(root, "features")
    if schema is None:
        return load_version(spark.read.parquet(path), runs, version)
    flags = {f.name: F.coalesce(F.col(f"`{f.name}`"), F.lit(False)) for f in schema.fields if isinstance(f.dataType, T.BooleanType)}
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("processing_version", T.StringType())])).parquet(path)
    return load_version(rows.withColumns(flags), runs, version)


def append_predictions(pred: DataFrame, root: str, source: str | None = None) -> None:
    """Append scored rows partitioned by prediction_id (S8). The
    ``prediction_source`` column tags interactive scoring (S9); it is always
    written (null for batch runs) so every append has the same schema."""
    pred = pred.withColumn("prediction_source", F.lit(source).cast("string"))
    pred.write.mode("append").partitionBy("prediction_id").parquet(os.path.join(root, "predictions"))
