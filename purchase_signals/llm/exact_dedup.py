"""Exact dedup by a tree merge of sorted digest runs.

Every input partition is a run of (digest, smallest id, count).  In each round
``FAN_IN`` neighbouring runs (three binomial rounds in one) are merged: the
rows of a digest in the merged runs meet, the smallest identifier and the sum
of counts stay.  The last round has one run.  A merged run is itself spread
over all tasks by digest, so no task ever holds a whole run, and a digest
carried by a third of all rows costs one row per run, never one per document.

Two rows are merged only if their SHA-256, their byte length and an
independent 64-bit hash of the normalised text all agree (verification).
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TAG, columns, prepare, stage, tag_rows

FAN_IN_BITS = 3
KEY = ["text_sha256", "n_bytes", "second_hash"]


def digests(docs: DataFrame, tag: Column | None = None) -> DataFrame:
    """(doc_id, digest key, tag, run) of every row; ``tag`` tells equal rows apart."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.withColumn("t", text).select(
        "doc_id",
        F.sha2("t", 256).alias("text_sha256"),
        F.octet_length("t").cast("long").alias("n_bytes"),
        F.xxhash64("t").alias("second_hash"),
        (F.monotonically_increasing_id() if tag is None else tag).alias("tag"),
        F.spark_partition_id().alias("run"),
    )


def merge_runs(runs: DataFrame, top: int) -> DataFrame:
    """Merge (run, key, head, n) level by level until one run is left."""
    def merged(df: DataFrame) -> DataFrame:
        return df.groupBy("run", *KEY).agg(F.min("head").alias("head"), F.sum("n").alias("n"))

    out = merged(runs)
    while top > 0:
        top >>= FAN_IN_BITS
        out = merged(out.withColumn("run", F.shiftright("run", FAN_IN_BITS)))
    return out.drop("run")


def decided(rows: DataFrame) -> DataFrame:
    """The staged rows of ``digests`` with keep_id, keep_tag and group_size of their group."""
    top = rows.agg(F.max("run")).first()[0] or 0
    head = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    best = merge_runs(rows.select("run", *KEY, head.alias("head"), F.lit(1).cast("long").alias("n")), top)
    best = best.select(*KEY, F.col("head.doc_id").alias("keep_id"), F.col("head.tag").alias("keep_tag"),
                       F.col("n").alias("group_size"))
    return rows.join(best, KEY)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, so all null and empty texts are one group.  Rows
    with a null id rank last.  Of rows repeated with the same id and text one is
    kept.  An empty table gives an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = stage(digests(columns(docs, id_col, text_col)), "digests")
    return decided(rows).select(
        "doc_id", "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each
    group, told by its tag, so rows repeated with the same id (or none) and text
    are rows of their own.  The list of tags that go is written first, so the
    planner knows its size: it broadcasts a short one and shuffles for a long one.
    """
    prepare(docs.sparkSession)
    tagged, tag = tag_rows(docs)
    rows = columns(tagged, id_col, text_col, F.col(tag).alias(TAG))
    rows = stage(digests(rows, F.col(TAG)), "digests")
    gone = stage(decided(rows).where("tag <> keep_tag").select(F.col("tag").alias(tag)), "dropped")
    return tagged.join(gone, tag, "left_anti").select(docs.columns)
