"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage reads all that its predecessor kept; all but the last return the
columns of ``documents``.  ``run`` writes every stage as Parquet in the shared
folder and reads it back.  Language ID, near duplicates, personal data and
packing are beyond SQL, so there is no ORACLE_SQL; tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purchase_signals.llm import exact_dedup as exact
from purchase_signals.llm import jaccard, langid, packing, pii
from purchase_signals.llm.common import free_name, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter go; the others stay and get the
    predicted language as their ``lang`` (their own where none was learned).
    Repeated rows are judged alike; an empty table stays empty."""
    profiles = langid.fit(docs)
    pred = free_name(docs, "lang_pred")
    tagged = langid.annotate(docs, profiles, pred_col=pred).where(F.col(pred).isNotNull())
    return (tagged.withColumn("lang", F.col(pred)) if profiles.languages else tagged).select(docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to white space) the one with the smallest doc_id stays
    (rows without id last; of repeated rows one; null text counts as empty)."""
    return exact.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest doc_id stays
    (rows without id last; of repeated rows one).  Null and wordless texts are
    linked with nothing and all stay."""
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks; ``n_chars`` follows.  A null
    text stays null with null ``n_chars``; every row stays, repeated ones too."""
    clean = pii.mask(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4,096 ids.  A null or empty text is its
    document's end id alone; repeated rows are documents of their own; an empty
    table gives no pieces."""
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("ngram_jaccard", near_duplicates),
          ("pii", personal_data), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
