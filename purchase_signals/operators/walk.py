"""Scoring by a forest that stays a table (M5): its deep nodes are never at the
driver and no task holds more of them than ``CHUNK_NODES``.

The tops of the trees, a few nodes each, are with every task. Below them a forest
is dealt in chunks: small trees several to a chunk, a large tree by the leaves of
its top over several. A row goes, as bins, to every chunk that it has a leaf in, at
most one for each tree, and comes back as the chunk's votes; the votes of a row are
summed in the order of the trees, as MLlib does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Nodes of a chunk; rows that meet a chunk in one task; tasks that small inputs are dealt to, and their least rows.
CHUNK_NODES, BLOCK_ROWS, LEAST_TASKS, LEAST_ROWS = 2_000_000, 250_000, 16, 4096


def values_of(b: pa.RecordBatch, first: int) -> np.ndarray:
    """The columns from ``first`` on as one matrix, a row for each row."""
    return np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(first, b.num_columns)], 1).astype(float)


def bins_of(values: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """Values as numbers of bins: at most ``c`` where they are at most the threshold ``c``."""
    wide = np.uint8 if max(map(len, points), default=0) < 256 else np.uint16
    return np.stack([np.searchsorted(p, values[:, i]) for i, p in enumerate(points)], 1).astype(wide)


def places(route: tuple, values: np.ndarray) -> np.ndarray:
    """The leaf of a tree's top that each row falls in."""
    feature, threshold, left, right, leaf, depth = route
    at, rows = np.zeros(len(values), np.int64), np.arange(len(values))
    for _ in range(depth):
        at = np.where(values[rows, feature[at]] <= threshold[at], left[at], right[at])
    return leaf[at]


def chunked(sizes: dict[tuple[int, int], int], trees: int) -> tuple[list[range], dict[tuple[int, int], int]]:
    """(trees of each chunk, chunk of each (tree, leaf) of a tree in several). ``sizes``
    are the nodes below each leaf of a top, the leaves in any order."""
    of_tree: dict[int, list[tuple[int, int]]] = {}
    for (tree, leaf), n in sorted(sizes.items()):
        of_tree.setdefault(tree, []).append((leaf, n))
    chunks, parts, room = [], {}, 0
    for tree in range(trees):
        mine = of_tree.get(tree, [])
        n = sum(x[1] for x in mine)
        if n > CHUNK_NODES:
            room = 0
            for leaf, m in mine:
                if m > room:
                    chunks.append(range(tree, tree + 1))
                    room = CHUNK_NODES
                room -= m
                parts[tree, leaf] = len(chunks) - 1
            room = 0
        elif n <= room:
            chunks[-1], room = range(chunks[-1].start, tree + 1), room - n
        else:
            chunks.append(range(tree, tree + 1))
            room = max(CHUNK_NODES - n, 1)
    return chunks, parts


class StoredForest:
    """A fitted forest in the files that MLlib saves and, below the tops, as packed
    subtrees. ``stages`` and ``transform`` are those of the MLlib model, which is
    loaded to the driver when they are first asked for; nothing else loads it."""

    def __init__(self, top: PipelineModel, path: str, data: str, features: list[str], points: list[np.ndarray], weight: np.ndarray,
                 routes: list[tuple], stats: dict[tuple[int, int], np.ndarray], subtrees: DataFrame) -> None:
        self.top, self.path, self.data, self.features, self.points = top, path, data, features, points
        self.weight, self.routes, self.stats, self.subtrees = weight, routes, stats, subtrees
        self._loaded: PipelineModel | None = None

    @property
    def loaded(self) -> PipelineModel:
        self._loaded = self._loaded or PipelineModel.load(self.path)
        return self._loaded

    @property
    def stages(self) -> list:
        return self.loaded.stages

    def transform(self, df: DataFrame) -> DataFrame:
        return self.loaded.transform(df)

    def write(self) -> ForestWriter:
        return ForestWriter(self)

    def votes(self, rows: DataFrame) -> DataFrame:
        """(row, votes) of rows with a number ``row`` and the features: the sums over the
        trees of the shares of each class."""
        trees, k = len(self.routes), len(self.weight)
        sizes = {(r.tree, r.leaf): r.nodes for r in self.subtrees.select("tree", "leaf", "nodes").collect()}  # one row for each subtree
        leaves = {key: sizes.get(key, 1) for key in self.stats}
        chunks, parts = chunked(leaves, trees)
        n = rows.count()
        least = min(math.ceil(LEAST_TASKS / len(chunks)), math.ceil(n / LEAST_ROWS))
        split = {tree for tree, _ in parts}
        raw: dict[int, float] = {}
        for (tree, leaf), stats in self.stats.items():
            if tree in split:
                raw[parts[tree, leaf]] = raw.get(parts[tree, leaf], 0) + stats.sum()
        # a part of a tree meets about its share of the rows
        share = [1.0 if c.start not in split else raw[i] / max(sum(v for j, v in raw.items() if chunks[j] == c), 1e-12) for i, c in enumerate(chunks)]
        blocks = [max(1, least, math.ceil(n * s / BLOCK_ROWS)) for s in share]
        tasks = 2 * sum(blocks)
        own = [(tree, leaf, i, blocks[i]) for tree, leaf in sizes for i in [parts[tree, leaf] if tree in split else next_chunk(chunks, tree)]]
        spark = rows.sparkSession
        placed = spark.createDataFrame(own, "tree int, leaf int, chunk int, blocks int")
        nodes = self.subtrees.select("tree", "leaf", "left", "feature", "cut", "counts").join(placed, ["tree", "leaf"]).select(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree", "leaf", "left", "feature", "cut", "counts")
        dealt = rows.select("row", *[f"`{f}`" for f in self.features]).mapInArrow(
            row_dealer(self.points, self.routes, chunks, parts, blocks), "chunk int, block int, ids binary, x binary, leaves binary")
        keys = ["chunk", "block"]
        walked = dealt.repartition(tasks, *keys).groupBy(*keys).cogroup(nodes.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(
            walker(self.weight, self.stats, chunks, len(self.points)), "row long, chunk int, votes array<double>")
        if len(chunks) == 1:
            return walked.select("row", "votes")
        nothing = F.array(*[F.lit(0.0)] * k)
        in_order = F.array_sort(F.collect_list(F.struct("chunk", "votes")))
        return walked.groupBy("row").agg(F.aggregate(in_order, nothing, lambda a, b: F.zip_with(a, b["votes"], lambda x, y: x + y)).alias("votes"))

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, predicted class and P(class 1) of every row; ``df`` has the features
        as doubles. Rows are told apart by number, so equal rows stay rows of their own."""
        x = df.select(F.struct(*keep).alias("_kept"), *[F.col(f"`{f}`") for f in self.features])
        x = stored(x.withColumn("row", F.monotonically_increasing_id()), "rows")
        total = F.aggregate("votes", F.lit(0.0), lambda a, b: a + b)
        p = self.votes(x).select("row", F.transform("votes", lambda v: v / total).alias("_p"),
                                 (F.array_position("votes", F.array_max("votes")) - 1).cast("int").alias("prediction"))
        return x.select("row", "_kept").join(p, "row").select(
            *[F.col("_kept").getField(k).alias(k) for k in keep], "prediction", F.col("_p")[1].alias("probability"))


class ForestWriter:
    """Saves a stored forest as the MLlib pipeline it is, from its files."""

    def __init__(self, forest: StoredForest) -> None:
        self.forest, self.replaces = forest, False

    def overwrite(self) -> ForestWriter:
        self.replaces = True
        return self

    def save(self, path: str) -> None:
        top = self.forest.top.write()
        (top.overwrite() if self.replaces else top).save(path)
        nodes = self.forest.subtrees.sparkSession.read.parquet(self.forest.data)
        nodes.write.mode("overwrite").parquet(f"{path}/stages/1_{self.forest.top.stages[-1].uid}/data")


def next_chunk(chunks: list[range], tree: int) -> int:
    return next(i for i, c in enumerate(chunks) if tree in c)


def row_dealer(points, routes, chunks, parts, blocks):
    """(row number, features) to the rows of each chunk, features as bins, with their
    leaves in the chunk's trees; a batch's rows travel as one."""
    few = np.uint16 if max(r[4].max() for r in routes) < 1 << 16 else np.uint32
    chunk_of: dict[int, np.ndarray] = {}
    for (tree, leaf), chunk in parts.items():
        chunk_of.setdefault(tree, np.full(1 + routes[tree][4].max(), -1))[leaf] = chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, values = b.column(0).to_numpy(), values_of(b, 1)
            if np.isnan(values).any():
                raise ValueError("a row to be scored has a null or NaN among its features")
            x, out = bins_of(values, points), []
            leaves = np.stack([places(r, values) for r in routes], 1).astype(few)
            # batches are dealt to a chunk's tasks by the number of their first row
            spot = int(ids[0]) * 0x9E3779B97F4A7C15 >> 32 & 0xFFFFFFF
            for i, c in enumerate(chunks):
                rows = slice(None) if c.start not in chunk_of else np.flatnonzero(chunk_of[c.start][leaves[:, c.start]] == i)
                if len(ids[rows]):
                    out.append((i, spot % blocks[i], ids[rows].tobytes(), x[rows].tobytes(), leaves[rows, c.start:c.stop].tobytes()))
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(types)], ["chunk", "block", "ids", "x", "leaves"])

    return run


def walker(weight, stats, chunks, width):
    """The rows and subtrees of a chunk to the rows' votes."""
    ends: dict[int, dict[int, np.ndarray]] = {}
    for (tree, leaf), s in stats.items():
        ends.setdefault(tree, {})[leaf] = s

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, nodes: pa.Table) -> pa.Table:
        k, chunk = len(weight), key[0].as_py()
        ids, x, leaves = (b"".join(rows.column(c).to_pylist()) for c in ("ids", "x", "leaves"))
        ids = np.frombuffer(ids, np.int64)
        n, trees = len(ids), chunks[chunk]
        votes = np.zeros((n, k))
        if n:
            x = np.frombuffer(x, np.uint8 if len(x) == n * width else np.uint16).reshape(n, -1)
            leaves = np.frombuffer(leaves, np.uint16 if len(leaves) == 2 * n * len(trees) else np.uint32).reshape(n, -1)
            below: dict[int, list[tuple]] = {}
            for tree, leaf, i in zip(nodes.column("tree").to_pylist(), nodes.column("leaf").to_pylist(), range(nodes.num_rows)):
                below.setdefault(tree, []).append((leaf, i))
            for j, tree in enumerate(trees):
                votes += tree_votes(x, leaves[:, j], ends[tree], nodes, below.get(tree, []), weight)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(votes.ravel()))
        return pa.table([pa.array(ids), pa.array(np.full(n, chunk, np.int32)), flat], names=["row", "chunk", "votes"])

    return run


def tree_votes(x, leaf, stats, nodes, subtrees, weight) -> np.ndarray:
    """Shares of the classes in the leaf that each row falls in. A leaf of the top
    without a subtree (here) is the end; the tree's subtrees are walked as one array."""
    k = len(weight)
    size = 1 + max(stats)
    ends = np.zeros((size, k))
    for i, s in stats.items():
        ends[i] = s
    start, left, feature, cut, weights = np.arange(size), [np.full(size, -1, np.int64)], [np.zeros(size, np.int32)], [np.zeros(size, np.uint16)], [ends]
    total = size
    for number, i in subtrees:
        of = {c: np.frombuffer(nodes.column(c)[i].as_py(), t) for c, t in (("left", np.int32), ("feature", np.int32), ("cut", np.uint16), ("counts", np.int64))}
        start[number] = total
        left.append(np.where(of["left"] < 0, -1, of["left"] + np.int64(total)))
        feature.append(of["feature"])
        cut.append(of["cut"])
        weights.append(of["counts"].reshape(-1, k) * weight)
        total += len(of["left"])
    left, feature, cut, weights = (np.concatenate(v) for v in (left, feature, cut, weights))
    at, going = start[leaf], np.arange(len(leaf))
    while len(going):
        here = at[going]
        inner = left[here] >= 0
        going, here = going[inner], here[inner]
        at[going] = left[here] + (x[going, feature[here]] > cut[here])
    found = weights[at]
    whole = found.sum(1, keepdims=True)
    return np.divide(found, whole, out=np.zeros_like(found), where=whole != 0)
