"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred rows, each step multiplies X by a right vector v (a task's
rows give their part of u = Xv) and the transpose by u (the parts of Xᵀu are
added up), both in one pass over the rows.  Right and left vectors are
reorthogonalised against all earlier ones, twice.  A left vector has an entry for
every row; it is never stored: u_j = X p_j, with p_j as wide as an embedding, and
its products with earlier ones follow from p_j and the vectors Xᵀu_i already
known.  The small bidiagonal matrix' singular value decomposition then gives the
components (right vectors times its right singular vectors) and their deviations.
The driver holds vectors of the embedding's width, never one per row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stage

COMPONENTS = 32
#: Rows of one block of vectors.
BLOCK = 2048
#: Tasks that add up the other tasks' sums; the driver adds theirs.
TREE = 4
#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64.0, 1_000_000
#: Greatest |floor(SCALE * c)|: beyond it a double is no exact integer.
LARGEST = 2.0 ** 52
#: Ritz pairs whose residual is under this share of the first singular value have converged.
TOLERANCE = 1e-13
#: A singular value under this share of the first counts as zero (a product with
#: both X and its transpose cannot tell smaller ones from rounding).
ZERO = 1e-7
SEED = 13


def usable(batch: pa.RecordBatch):
    """(ids, integer vectors by width) of a batch: rows without vector or with
    null, non-finite or too large entries take no part."""
    ids, vectors = batch.column("vec_id"), batch.column("v")
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    sizes = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    flat = vectors.flatten()
    null = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(values * SCALE)
    bad = np.concatenate(([0], np.cumsum(null | ~(np.abs(whole) < LARGEST))))
    good = (sizes > 0) & (bad[starts + sizes] == bad[starts])
    for width in np.unique(sizes[good]):
        at = np.flatnonzero(good & (sizes == width))
        x = whole[starts[at][:, None] + np.arange(width)].astype(np.int64)
        yield int(width), ids.take(pa.array(at)), x


def to_blocks(batches):
    """Blocks of vectors of one width: ids and integer entries as bytes."""
    for batch in batches:
        for width, ids, x in usable(batch):
            for at in range(0, len(x), BLOCK):
                part = x[at:at + BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([width], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary()),
                     pa.array([ids.slice(at, BLOCK).to_pylist()], pa.list_(pa.int64())), pa.array([part.sum(0).tolist()], pa.list_(pa.int64()))],
                    ["width", "n", "x", "ids", "total"])


@dataclass
class Table:
    """The fit list: staged blocks, rows, exact sums by dimension."""
    blocks: DataFrame
    n: int
    sums: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        """Mean of floor(64 c); the shift leaves every centred value as it is."""
        return self.sums / max(self.n, 1)


def added(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of arrays of doubles, one per task, by way of ``TREE`` tasks."""
    def add(batches):
        total = np.zeros(width)
        for b in batches:
            for v in b.column("part").to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return sum((np.frombuffer(r.part) for r in parts.repartition(TREE).mapInArrow(add, "part binary").collect()), np.zeros(width))


def load(embeddings: DataFrame, id_col: str, vector_col: str) -> Table | None:
    rows = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), embeddings[vector_col].cast("array<double>").alias("v"))
    blocks = stage(rows.mapInArrow(to_blocks, "width int, n long, x binary, ids array<long>, total array<long>"), "vectors")
    widths = blocks.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if widths is None:
        return None
    blocks = blocks.where(F.col("width") == widths.width)
    per_dim = blocks.select(F.posexplode("total")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()  # one row per dimension
    return Table(blocks, widths.n, np.array([r.s for r in per_dim], np.int64))


def product(table: Table, p: np.ndarray) -> np.ndarray:
    """Xᵀ(Xp) in one pass: u = Xp row by row, then the rows weighted by u."""
    mean, width = table.mean, table.width

    def part(batches):
        total = np.zeros(width)
        for b in batches:
            for v in b.column("x").to_pylist():
                x = np.frombuffer(v, np.int64).reshape(-1, width) - mean
                total += x.T @ (x @ p)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return added(table.blocks.select("x").mapInArrow(part, "part binary"), width)


def orthogonal(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - basis.T @ (basis @ w)
    return w


@dataclass
class Components:
    """Unit components (rows), their variances (divisor n) by falling size, and
    the share of the whole variance that each explains."""
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def bidiagonalise(table: Table, k: int = COMPONENTS) -> Components:
    """The first ``k`` components (fewer if the rows span fewer dimensions).

    Steps go on until the first ``k`` Ritz values have residuals under
    ``TOLERANCE`` of the largest, or the width is reached.  A step that finds
    nothing new (an invariant subspace, equal deviations) starts again with a
    vector orthogonal to all before.
    """
    width, rng = table.width, np.random.default_rng(SEED)
    v_all, p_all, g_all = np.zeros((0, width)), np.zeros((0, width)), np.zeros((0, width))
    alphas, betas = [], []
    v, p_before, beta, scale = rng.standard_normal(width), np.zeros(width), 0.0, 0.0
    v /= np.linalg.norm(v)
    while len(alphas) < width:
        v_all = np.vstack([v_all, v])
        # u = X v - beta u_before, held as u = X p
        p = v - beta * p_before
        g = product(table, p)
        for _ in range(2):  # its products with earlier left vectors
            c = p_all @ g
            p, g = p - p_all.T @ c, g - g_all.T @ c
        alpha = np.sqrt(max(p @ g, 0.0))
        scale = max(scale, alpha)
        if alpha <= ZERO * scale:
            alpha, p, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            p, g = p / alpha, g / alpha
        alphas.append(alpha)
        p_all, g_all, p_before = np.vstack([p_all, p]), np.vstack([g_all, g]), p
        w = orthogonal(g - alpha * v, v_all)
        beta = float(np.linalg.norm(w))
        scale = max(scale, beta)
        again = beta <= TOLERANCE * scale
        if again:
            beta = 0.0
        if len(alphas) >= min(k, width):
            left, s, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if len(alphas) == width or (not again and np.all(beta * np.abs(left[-1, :k]) <= TOLERANCE * s[0])):
                break
        betas.append(beta)
        if again:
            w = orthogonal(rng.standard_normal(width), v_all)
            beta = 0.0
        v = w / np.linalg.norm(w)
    left, s, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1))
    keep = np.flatnonzero(s[:k] > ZERO * s[0])
    vectors = right[keep] @ v_all
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) if len(keep) else 1.0
    return Components(vectors, s[keep] ** 2 / table.n, s[keep] ** 2 / max(total_square(table), np.finfo(float).tiny))


def total_square(table: Table) -> float:
    """The sum of all squared centred entries (n times the trace of V)."""
    mean, width = table.mean, table.width

    def part(batches):
        total = 0.0
        for b in batches:
            for v in b.column("x").to_pylist():
                x = np.frombuffer(v, np.int64).reshape(-1, width) - mean
                total += float((x * x).sum())
        yield pa.RecordBatch.from_arrays([pa.array([np.array([total]).tobytes()], pa.binary())], ["part"])

    return float(added(table.blocks.select("x").mapInArrow(part, "part binary"), 1)[0])


def whitened_rows(v: bytes, table_mean: np.ndarray, found: Components) -> np.ndarray:
    x = np.frombuffer(v, np.int64).reshape(-1, len(table_mean)) - table_mean
    return x @ found.vectors.T / np.sqrt(found.variances)


def identity_error(table: Table, found: Components) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, mean = len(found.variances), table.mean

    def part(batches):
        total = np.zeros(k * k + k)
        for b in batches:
            for v in b.column("x").to_pylist():
                w = whitened_rows(v, mean, found)
                total += np.concatenate(((w.T @ w).ravel(), w.sum(0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = added(table.blocks.select("x").mapInArrow(part, "part binary"), k * k + k) / table.n
    m = total[k * k:]
    return float(np.abs(total[:k * k].reshape(k, k) - np.outer(m, m) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Sum over dimensions of (n x - S)^2, exact; null if it is no 64-bit integer."""
    far = float(np.abs(x).max(initial=0)) * n + float(np.abs(sums).max(initial=0))
    if far < 2.0 ** 62:
        d = x * np.int64(n) - sums
        if float(np.abs(d).max(initial=0)) ** 2 * len(sums) < 2.0 ** 62:
            return (d * d).sum(1).tolist()
        d = d.astype(object)
    else:
        d = x.astype(object) * n - sums.astype(object)
    return [s if s < 2 ** 63 else None for s in (d * d).sum(1)]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error.

    Rows whose vector is null or empty, or holds null, non-finite or too large
    entries (64 c beyond 2^52) take no part, nor do those not as wide as most
    vectors (of equally common widths the largest counts).  Rows repeated or
    without id each count and stay.  Components of no variance are not returned,
    so equal vectors and an empty table give no rows.  A deviation beyond 64 bits
    is null.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    table = load(embeddings, id_col, vector_col)
    found = bidiagonalise(table, k) if table is not None else None
    if found is None or not len(found.variances):
        return spark.createDataFrame([], schema)
    n, sums, mean, error, m = table.n, table.sums, table.mean, identity_error(table, found), len(found.variances)

    def rows(batches):
        for b in batches:
            for ids, v in zip(b.column("ids").to_pylist(), b.column("x").to_pylist()):
                x = np.frombuffer(v, np.int64).reshape(-1, len(sums))
                w = whitened_rows(v, mean, found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i in ids for _ in range(m)], pa.int64()), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * m, n, np.int64)), pa.array([d for d in deviations(x, n, sums) for _ in range(m)], pa.int64()),
                    pa.array(w.ravel()), pa.array(np.tile(found.explained, len(x))), pa.array(np.full(len(x) * m, error))],
                    [c.split()[0] for c in schema.split(", ")])

    return table.blocks.select("ids", "x").mapInArrow(rows, schema)
