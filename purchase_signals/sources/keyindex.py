"""Index of stored keys: folders by run and hash prefix, with a Bloom filter each.
The more keys a run has, the longer its prefixes: a small run is one folder.

    <table>/run=<id>/prefix=<p..>/     keys (32 hex digits), sorted
    <table>_blooms/run=<id>/           prefix, number of keys, filter

Which of a batch's keys are stored is asked in two steps.  The batch's keys, put
together by prefix, meet the filters of that prefix; the folders that any key may
be in are read through a partition filter, and only they are joined.  The join
keeps the smaller side's keys, so a small batch is broadcast by its size and the
stored keys are read where they lie.  Runs that are not committed are never read,
and a run writes only its own folders, so a retry replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .files import read_or_empty

#: A run's prefixes get one more hex digit while its folders would hold more keys than this.
KEYS_PER_FOLDER, MAX_DIGITS = 500_000, 4
#: Bits of a filter for each key, and bits that a key sets: one in a hundred other keys passes.
KEY_BITS, PROBES = 12, 3
#: Keys of a batch that meet a filter in one row.
CHUNK = 50_000

KEYS_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("run", T.StringType()), T.StructField("prefix", T.StringType())])
BLOOM_SCHEMA = T.StructType([T.StructField("prefix", T.StringType()), T.StructField("n", T.LongType()), T.StructField("bits", T.BinaryType()),
                             T.StructField("run", T.StringType())])


def key_hash(cols: list[str]) -> Column:
    """32 hex digits of the key columns; null if one of them is null (such rows
    are equal to nothing stored)."""
    texts = [F.col(c).cast("string") for c in cols]
    return F.when(F.greatest(*[t.isNull() for t in texts], F.lit(False)), F.lit(None)).otherwise(
        F.md5(F.concat_ws("|", *[F.concat(F.char_length(t).cast("string"), F.lit(":"), t) for t in texts])))


def digits_of(n: int) -> int:
    """Hex digits of the prefixes of a run with ``n`` keys."""
    return next((d for d in range(MAX_DIGITS) if n <= KEYS_PER_FOLDER * 16 ** d), MAX_DIGITS)


def prefix_of(key: str, digits: int) -> Column:
    return F.concat(F.lit("p"), F.substring(key, 1, digits))


def positions(keys: list[str], size: int) -> np.ndarray:
    """The bits that each key sets in a filter of ``size`` bits: (key, probe)."""
    raw = np.frombuffer(bytes.fromhex("".join(k[8:8 + 8 * PROBES] for k in keys)), ">u4").reshape(-1, PROBES)
    return raw.astype(np.int64) % size


def size_of(n: int) -> int:
    return max(64, -(-n * KEY_BITS // 8) * 8)


def bloom_writer(counts: dict[str, int]):
    """Sorted (prefix, key) rows to one filter for each prefix."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, bits = None, None

        def done():
            yield pa.RecordBatch.from_arrays([pa.array([prefix]), pa.array([counts[prefix]]), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                             ["prefix", "n", "bits"])

        for b in batches:
            names, keys = b.column("prefix").to_pylist(), b.column("key").to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if names[i] != prefix:
                    if prefix is not None:
                        yield from done()
                    prefix = names[i]
                    bits = np.zeros(size_of(counts[prefix]), np.uint8)
                bits[positions(keys[i:j], len(bits)).ravel()] = 1
        if prefix is not None:
            yield from done()

    return write


def add_keys(keys: DataFrame, root: str, table: str, run: str) -> None:
    """Index the distinct non-null values of column ``key`` under ``run``."""
    spark = keys.sparkSession
    rows = stored(keys.select("key").where(F.col("key").isNotNull()).distinct(), "keys")
    rows = rows.withColumn("prefix", prefix_of("key", digits_of(rows.count())))
    path = f"{root}/{table}/run={run}"
    rows.repartition("prefix").sortWithinPartitions("prefix", "key").write.mode("overwrite").partitionBy("prefix").parquet(path)
    written = read_or_empty(spark, path, T.StructType([KEYS_SCHEMA["key"], KEYS_SCHEMA["prefix"]]))
    counts = {r.prefix: r["count"] for r in written.groupBy("prefix").count().collect()}  # at most 16 ** MAX_DIGITS
    blooms = written.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(bloom_writer(counts), "prefix string, n long, bits binary")
    blooms.write.mode("overwrite").parquet(f"{root}/{table}_blooms/run={run}")


def indexed_runs(spark: SparkSession, root: str, table: str) -> set[str]:
    """Runs with a written index (one entry for each run)."""
    return {r.run for r in read_or_empty(spark, f"{root}/{table}_blooms", BLOOM_SCHEMA).select("run").distinct().collect()}


def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, prefix) of the filters that one of the keys beside them passes."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8))
            if bits[positions(r["keys"], len(bits))].all(1).any():
                out.append((r["run"], r["prefix"]))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in (0, 1)], ["run", "prefix"])


def folders(keys: DataFrame, root: str, table: str, runs: list[str]) -> list[str]:
    """``run/prefix`` folders of the given runs that may hold one of ``keys`` (staged)."""
    if not runs:
        return []
    spark = keys.sparkSession
    blooms = read_or_empty(spark, f"{root}/{table}_blooms", BLOOM_SCHEMA).where(F.col("run").isin(runs))
    used = [r[0] for r in blooms.select(F.char_length("prefix") - 1).distinct().collect()]  # at most MAX_DIGITS + 1
    if not used:
        return []
    n = keys.count()
    asked = []
    for digits in sorted(used):
        chunks = max(1, -(-n // (CHUNK * 16 ** digits)))
        part = keys.withColumn("prefix", prefix_of("key", digits)).withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)))
        asked.append(part.groupBy("prefix", "chunk").agg(F.collect_list("key").alias("keys")))
    hit = blooms.join(reduce(DataFrame.unionByName, asked), "prefix").select("run", "prefix", "bits", "keys").mapInArrow(passes, "run string, prefix string").distinct()
    return sorted(f"{r.run}/{r.prefix}" for r in hit.collect())


def candidates(keys: DataFrame, root: str, table: str, runs: list[str]) -> DataFrame:
    """Stored keys of the folders that may hold one of ``keys``."""
    names = folders(keys, root, table, runs)
    index = read_or_empty(keys.sparkSession, f"{root}/{table}", KEYS_SCHEMA)
    return index.where(F.concat_ws("/", "run", "prefix").isin(names)) if names else index.limit(0)


def unseen(rows: DataFrame, key: Column, root: str, table: str, runs: list[str]) -> DataFrame:
    """The rows whose key no given run has stored; rows with a null key always.

    ``rows`` are read twice, once for their keys alone: hand over rows that lie in
    files (``stored``), or narrow work on such rows. Without a run they are all
    unseen, and nothing is asked."""
    if not runs:
        return rows
    rows = rows.withColumn("__key", key)
    asked = stored(rows.select(F.col("__key").alias("key")).where(F.col("key").isNotNull()).distinct(), "asked-keys")
    hits = stored(candidates(asked, root, table, runs).select("key").join(asked, "key").select(F.col("key").alias("__key")).distinct(), "hits")
    return rows.join(hits, "__key", "left_anti").drop("__key")
