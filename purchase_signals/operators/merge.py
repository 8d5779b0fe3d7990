"""Incremental featurization and versioned merge.

A version directory holds the rows the version added; the run row in
``feature_runs`` is written last and is the commit: readers take the committed
versions from it, so a half-written version is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, column: str = "log_ts") -> DataFrame:
    """max(column) as a one-row frame (A3)."""
    return df.select(F.max(column).alias("high_water_mark"))


def incremental_rows(raw: DataFrame, processed: DataFrame, column: str = "log_ts") -> DataFrame:
    """Rows strictly newer than the processed high-water mark (P1). With no
    processed rows the mark is null and every row qualifies."""
    hw = processed.select(F.max(column)).scalar()
    return raw.where(hw.isNull() | (F.col(column) > hw))


def merge_existing_wins(existing: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Existing rows first, then new rows whose key is not in ``existing``
    (J2 + U1). Columns are unioned by name; missing ones become null.

    The existing key set is reduced with a map-side distinct before the
    anti-join, so a hot key contributes one row per task to the shuffle.
    """
    key = key or ["user_id"]
    known = existing.select(*key).distinct()
    fresh = new.join(known, key, "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def load_version(features: DataFrame, runs: DataFrame, version: str | None = None) -> DataFrame:
    """The feature table as of one version, the latest committed by default
    (S4): rows of every committed version up to it (each version stores the
    rows it added), stamped with that version. Uncommitted version folders
    are never read; on a table partitioned by processing_version the
    semi-join against the (small) run table prunes partitions dynamically."""
    wanted = versions_up_to(runs, version)
    stamp = wanted.select(F.max_by("processing_version", "processed_at")).scalar()
    return features.join(wanted.select("processing_version"), "processing_version", "left_semi") \
        .withColumn("processing_version", stamp)


def versions_up_to(runs: DataFrame, version: str | None = None) -> DataFrame:
    """Committed versions at or before ``version`` (default: all), one row
    per run (the run table grows by one row per featurization)."""
    if version is None:
        return runs.select("processing_version", "processed_at")
    at = runs.where(F.col("processing_version") == F.lit(version)).select(F.max("processed_at")).scalar()
    return runs.where(F.col("processed_at") <= at).select("processing_version", "processed_at")
