"""Approximate nearest neighbours by multiprobe p-stable hashing.

Table t hashes a vector by M functions floor((a . x + b) / w), a drawn from the
normal (2-stable) distribution; the M numbers name its bucket.  A query visits,
in every table, its own bucket and then perturbed ones (one or more of the
numbers moved by one) in the order of their estimated success: the sum of the
squared distances from the query to the boundaries it would cross, smallest
first.  Candidates of all tables are merged and ranked by their exact distance.

The bucket width and the number of probes are fitted on a bounded sample of the
vectors (``SAMPLE`` vectors, ``TRIALS`` of them as queries) so that the recall
on the sample reaches ``RECALL``; every vector is indexed.

Equal vectors are one entry of the index that carries its ``k + 1`` smallest
ids, which is all a result can need of them.  Entries are dealt to blocks by
table, bucket and, for buckets over ``SPLIT`` entries, a salt; probes go to every
salt of their bucket, so a crowded bucket is searched by many tasks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stage

TABLES, FUNCTIONS = 8, 6
SAMPLE, TRIALS, RECALL = 4000, 60, 0.97
PROBES = (8, 16, 32, 64, 128, 256)
SPLIT = 5000
SEED = 17


@dataclass(frozen=True)
class Hashes:
    a: np.ndarray  # (tables * functions, dims)
    b: np.ndarray
    width: float
    probes: int

    def project(self, x: np.ndarray) -> np.ndarray:
        """Positions on the hash lines in bucket widths: (vector, table, function)."""
        return ((x @ self.a.T + self.b * self.width) / self.width).reshape(len(x), TABLES, FUNCTIONS)

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        """A 63-bit name for each row of hash numbers."""
        h = np.zeros(cells.shape[:-1], np.uint64)
        for k in range(FUNCTIONS):
            h = (h ^ (cells[..., k].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return (h >> np.uint64(1)).astype(np.int64)


def perturbations(fraction: np.ndarray, n: int) -> list[np.ndarray]:
    """The ``n`` best moves of the hash numbers, the empty one first, by the sum
    of squared distances to the boundaries crossed.  ``fraction``: the place in
    the bucket, 0 to 1, for each function.

    Moves are kept sorted by their distance; from a set with greatest member i
    come the sets with i replaced by i + 1 and with i + 1 added, so the heap
    yields every set once and in order.
    """
    m = len(fraction)
    moves = sorted([(float(f) ** 2, k, -1) for k, f in enumerate(fraction)] + [(float(1 - f) ** 2, k, 1) for k, f in enumerate(fraction)])
    out, heap = [np.zeros(m, np.int64)], [(moves[0][0], (0,))]
    while heap and len(out) < n:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(heap, (cost - moves[last][0] + moves[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + moves[last + 1][0], (*chosen, last + 1)))
        if len({moves[i][1] for i in chosen}) == len(chosen):  # a number cannot move both ways
            delta = np.zeros(m, np.int64)
            for i in chosen:
                delta[moves[i][1]] = moves[i][2]
            out.append(delta)
    return out


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances in double precision."""
    d = x.astype(np.float64) - q.astype(np.float64)
    return np.sqrt((d * d).sum(1))


def fit(sample: np.ndarray, k: int) -> Hashes:
    """Width and probes for the smallest scanned share that reaches ``RECALL`` on the sample."""
    rng = np.random.default_rng(SEED)
    dims = sample.shape[1] if sample.ndim == 2 and len(sample) else 1
    a, b = rng.normal(0, 1, (TABLES * FUNCTIONS, dims)), rng.random(TABLES * FUNCTIONS)
    if len(sample) < 2:
        return Hashes(a, b, 1.0, PROBES[0])
    sample = sample.astype(np.float64)
    queries = sample[np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int)]
    d = np.stack([distances(q, sample) for q in queries])
    near = np.argsort(d, axis=1, kind="stable")[:, :k + 1]
    base = float(np.median(np.take_along_axis(d, near[:, -1:], 1))) or float(d.max()) or 1.0
    tried = []
    for scale in (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0):
        h = Hashes(a, b, base * scale, PROBES[-1])
        names, places = h.bucket(np.floor(h.project(sample))), h.project(queries)
        rank = np.full((len(queries), len(sample)), PROBES[-1] + 1)  # the probe that first meets a vector
        for i, place in enumerate(places):
            for t in range(TABLES):
                probe = probed(h, place[t])
                first = {v: r for r, v in reversed(list(enumerate(probe.tolist(), 1)))}
                seen = np.fromiter((first.get(v, PROBES[-1] + 1) for v in names[:, t].tolist()), np.int64, len(sample))
                rank[i] = np.minimum(rank[i], seen)
        for n in PROBES:
            hit = rank <= n
            tried.append((np.take_along_axis(hit, near, 1).mean(), hit.mean(), base * scale, n))
    good = [x for x in tried if x[0] >= RECALL]
    _, _, width, probes = min(good, key=lambda x: x[1]) if good else max(tried, key=lambda x: x[0])
    return Hashes(a, b, width, probes)


def probed(h: Hashes, place: np.ndarray) -> np.ndarray:
    """Names of the buckets a query visits in one table, best first."""
    cell = np.floor(place)
    return h.bucket(cell + np.array(perturbations(place - cell, h.probes)))


ENTRY = "vector array<double>, ids array<long>, bucket_table int, bucket long"


def indexed(frames, h: Hashes):
    """Every entry once for each table, under its bucket."""
    for f in frames:
        if len(f):
            names = h.bucket(np.floor(h.project(np.stack(f["vector"].to_list()))))
            for t in range(TABLES):
                yield f.assign(bucket_table=np.int32(t), bucket=names[:, t])


def probes_of(frames, h: Hashes):
    """Every query once for each bucket it visits."""
    for f in frames:
        for q, v in zip(f["query_id"], f["vector"], strict=True):
            place = h.project(np.asarray(v)[None])[0]
            for t in range(TABLES):
                names = np.unique(probed(h, place[t]))
                yield pd.DataFrame({"query_id": q, "vector": [v] * len(names), "bucket_table": np.int32(t), "bucket": names})


def search(k: int):
    """The ``k`` nearest of each query of a block among the entries of the
    buckets it visits there."""
    key = ["bucket_table", "bucket", "salt"]

    def run(entries: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(probes):
            vectors, at = np.stack(entries["vector"].to_list()), entries.groupby(key, sort=False).indices
            for name, rows in probes.groupby(key, sort=False):
                here = at.get(name)
                if here is None:
                    continue
                x = vectors[here]
                for q, v in zip(rows["query_id"], rows["vector"], strict=True):
                    d = distances(np.asarray(v), x)
                    near = np.argsort(d, kind="stable")
                    if len(near) > k + 1:  # all that tie with the last one stay
                        near = near[d[near] <= d[near[k]]]
                    found = [(d[j], i) for j in near for i in entries["ids"].iat[here[j]] if i != q]
                    out += [(q, i, s) for s, i in sorted(found)[:k]]
        found = pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        found = found.drop_duplicates(["query_id", "vec_id"]).sort_values(["query_id", "score", "vec_id"])
        return found.groupby("query_id").head(k)

    return run


RESULT = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of the ``k``
    nearest found of every row whose id divides by ``every``.

    Nearest first, ties to the smaller id; a row is no candidate of its own
    query.  Vectors that are null, empty, zero, hold null or non-finite
    components or have another length than most take no part, nor do rows
    without id.  A row repeated with the same id and vector counts once.  With
    ``k`` candidates or fewer all are returned: queries for which the buckets
    hold too few are searched against all entries in blocks.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    sizes = v.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = v.where(F.size("vector") == sizes[0].n)
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = v.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    entries = stage(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    queries = v.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    total, ids = entries.agg(F.count(F.lit(1)), F.sum(F.size("ids"))).first()
    sample = entries.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / total)))
    drawn = sample.select("vector").orderBy(F.xxhash64("vector")).limit(2 * SAMPLE).collect()
    h = fit(np.array([r.vector for r in drawn], float), k)

    index = stage(entries.mapInPandas(lambda f: indexed(f, h), ENTRY), "ann-index")
    probes = queries.mapInPandas(lambda f: probes_of(f, h), "query_id long, vector array<double>, bucket_table int, bucket long")
    key, blocks = ["bucket_table", "bucket"], 1 + total * TABLES // (4 * SPLIT)
    crowded = index.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("salts")).where("salts > 1")
    salts = F.coalesce("salts", F.lit(1))
    entry_salt = F.pmod(F.xxhash64("vector"), salts).cast("int")
    block = F.pmod(F.xxhash64(*key, "salt"), F.lit(blocks)).alias("block")
    left = index.join(crowded, key, "left").withColumn("salt", entry_salt).select("vector", "ids", *key, "salt", block)
    right = (probes.join(crowded, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
             .select("query_id", "vector", *key, "salt", block))
    found = left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(search(k), RESULT)
    found = stage(best(found, k), "ann-found")

    short = queries.join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left").where(
        F.coalesce("n", F.lit(0)) < min(k, ids - 1)).select("query_id", "vector")
    if short.isEmpty():
        return found
    parts = 1 + total // (4 * SPLIT)
    whole = [F.lit(0).alias("bucket_table"), F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("salt")]
    left = entries.select("vector", "ids", *whole, F.pmod(F.xxhash64("vector"), F.lit(parts)).alias("block"))
    right = short.select("query_id", "vector", *whole, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("block"))
    rest = best(left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(search(k), RESULT), k)
    return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(rest)


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
