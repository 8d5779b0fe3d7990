"""Helpers shared by the operators: staged tables and worker settings."""

from __future__ import annotations

import ctypes
import os
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to Python.  Texts are whole, so this bounds
#: a batch by rows and ``ARROW_BYTES`` bounds it by size.
ARROW_ROWS = 2000
ARROW_BYTES = 8 << 20
#: The column by which rows with equal ids are told apart, and its type.
TAG = "__row_tag"
TAG_TYPE = "struct<file:bigint,row:bigint>"


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: bounded Arrow batches, and for
    ``local`` masters the package's folder on the Python workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = sc.environment.get("PYTHONPATH", "")
        if root not in path.split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, path) if p)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage ends there, every executor can read it, and a lost executor
    re-reads files."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tag_rows(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a tag of its own for every row, and the tag's name (one that
    ``df`` has not).  Of a frame read from Parquet the tag is the row's file and
    number in it, so nothing is written again; any other frame is staged first."""
    tag = free_name(df, TAG)
    try:
        if not df._jdf.queryExecution().analyzed().children().isEmpty():
            df = stage(df, "tagged")
        return df.withColumn(tag, file_and_row()), tag
    except AnalysisException:  # no file behind it, so no such columns
        return stage(df, "tagged").withColumn(tag, file_and_row()), tag


def file_and_row() -> Column:
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lean(fn):
    """``fn`` (for ``mapInArrow``) that gives freed memory back to the system when
    its task ends.  Python workers live on from stage to stage beside the JVM, so
    what one stage has freed but kept would count against the next."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim is not None:
                trim(0)

    return run


def columns(df: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """The two columns an operator reads, under fixed names, so that extra
    columns of any name stay out of its plan (and ``others`` as they are)."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"), *others)
