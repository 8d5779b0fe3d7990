"""Ingest: content hash, new-record anti-join, in-batch reduction, upsert,
batch gate and uniqueness audit (F1, J1, S6, P2, S14, A1).

The stored log is append-only: an ingest run appends only records whose hash
is not stored yet, so hashes stay unique without a transactional format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.hashing import record_hash


def validated_key_fields(df: DataFrame, key_fields: list[str] | None = None) -> list[str]:
    """Key fields present in ``df``; error when none is left."""
    keys = key_fields or C.HASH_KEY_FIELDS
    present = [k for k in keys if k in df.columns]
    if not present:
        raise ValueError(f"none of the key fields {keys} is in the data")
    return present


def with_default_timestamp(df: DataFrame, run_ts, column: str = "log_ts") -> DataFrame:
    """The run time as ``column`` where the source has none (P4): no such
    column, or a row without a value in it."""
    run_ts = F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumn(column, F.coalesce(F.col(column).cast("timestamp_ntz"), run_ts) if column in df.columns else run_ts)


def with_record_hash(df: DataFrame, key_fields: list[str] | None = None) -> DataFrame:
    return df.withColumn("record_hash", record_hash(validated_key_fields(df, key_fields)))


def reduce_by_hash(df: DataFrame, order_col: str = "log_ts") -> DataFrame:
    """One row per record_hash: the latest ``order_col``, ties broken by the
    full row (deterministic, unlike an unordered last write). The maximum is
    combined map-side, so a hot hash never gathers its rows in one task, and the
    row is carried once, as the last part of its own order."""
    cols = [c for c in df.columns if c != "record_hash"]
    first = [F.col(order_col).alias("_order")] if order_col in cols else []
    return (df.groupBy("record_hash").agg(F.max(F.struct(*first, F.struct(*cols).alias("_row"))).alias("_r"))
            .select(*[F.col(f"_r._row.{c}").alias(c) for c in cols], "record_hash")
            .select(*df.columns))


def new_records(batch: DataFrame, stored_hashes: DataFrame) -> DataFrame:
    """Batch rows whose hash is not stored yet (J1), one per hash.

    Both sides are shuffled on record_hash (the stored key set is never
    collected or broadcast); the reduction's partitioning is reused by the
    anti-join.
    """
    keys = stored_hashes.select("record_hash")
    return reduce_by_hash(batch).join(keys, "record_hash", "left_anti")


def gate(df: DataFrame, min_rows: int) -> DataFrame:
    """All or nothing (P2): ``df`` when it has at least ``min_rows`` rows,
    else empty. The count is a scalar subquery (partial counts per task)."""
    n = df.select(F.count(F.lit(1))).scalar()
    return df.where(n >= F.lit(min_rows))


def upsert(stored: DataFrame, batch: DataFrame, min_rows: int = C.MIN_INGEST_BATCH) -> tuple[DataFrame, DataFrame]:
    """Return (rows to append, stored table after the append)."""
    fresh = gate(new_records(batch, stored), min_rows)
    return fresh, stored.unionByName(fresh.select(*stored.columns))


def duplicate_keys(stored: DataFrame) -> DataFrame:
    """Uniqueness audit (S14): hashes stored more than once."""
    return (stored.groupBy("record_hash").agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def ingest_stats(stored: DataFrame, batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row of ingest counters (A1), each a partial-aggregated count."""
    def n(df):
        return df.select(F.count(F.lit(1))).scalar()

    return stored.sparkSession.range(1).select(
        n(batch).alias("batch_records"),
        n(reduce_by_hash(batch)).alias("distinct_records"),
        n(fresh).alias("inserted_records"),
        n(stored).alias("stored_before"),
        (n(stored) + n(fresh)).alias("stored_after"),
    )
