"""The deep levels of a forest, grown where their rows are.

MLlib keeps a histogram of every open node in every task. Near the root these are
few; deep trees have about as many open nodes as rows, and nearly all of each
histogram is zeros. So MLlib grows the top of each tree, and below it Spark deals
the rows by (tree, leaf of the top) and every group grows its own subtree, a level
at a time over all its nodes. The work follows rows and depth, not partitions.
A leaf of the top with more than ``GROUP_ROWS`` rows is split first, a level in each
pass over the rows, by sums of the tasks' histograms, until no group has more.

Subtrees stay where they are grown: one row for each, its nodes as arrays. The
driver holds the tops alone, whatever the rows.

A row's weight in the bag of a tree is a Poisson(1) count drawn from a hash of the
row's number, the tree and the seed: the bags below the top are the same however
rows are laid out. Splits maximise the Gini gain over a fresh random subset of the
features at each node and thresholds at ``max_bins`` quantiles; a split whose two
leaves predict the same class is taken back, as MLlib does.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stored
from .walk import StoredForest, bins_of, places, values_of

#: Levels that MLlib grows: at most 8 groups of rows for each tree.
TOP_DEPTH = 3
#: Rows of a bag that one task grows a subtree of, and nodes split in one pass before that.
GROUP_ROWS, PASS_NODES = 1_000_000, 4096
ROW = "_id"
PACKED = "tree int, leaf int, nodes long, left binary, feature binary, cut binary, says binary, gain binary, counts binary"
_TYPES = {"left": np.int32, "feature": np.int32, "cut": np.uint16, "says": np.int32, "gain": np.float64, "counts": np.int64}
SUBTREE = ("tree int, leaf int, node long, left long, right long, prediction double, impurity double, "
           "stats array<double>, raw long, gain double, feature int, threshold double")
_TINY = 1e-12
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def subset_size(strategy: str, n: int) -> int:
    """Features tried at a node, as MLlib counts them."""
    return {"sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3), "all": n}[strategy]


def split_points(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Ascending thresholds of each feature: between its values if they are few,
    else at quantiles. One aggregate row, and one for the features of few values."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    one = rows.agg(*[F.struct(F.min(f).alias("low"), F.max(f).alias("high"), F.approx_count_distinct(f).alias("n"),
                              F.percentile_approx(f, shares).alias("q")).alias(f) for f in features]).first()
    few = [f for f in features if one[f].n <= 2 * bins]
    values = rows.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}
    out = []
    for f in features:
        v = np.unique(values[f]) if f in few else None
        if v is not None and len(v) <= bins:
            out.append((v[1:] + v[:-1]) / 2)
        else:
            q = np.unique([one[f].low, *one[f].q])
            out.append(q[q < one[f].high][-(bins - 1):])
    return out


def bag_counts(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the bag of a tree."""
    x = ids.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)) / float(1 << 53), side="right").astype(np.uint8)


def dealer(points: list[np.ndarray], routes: list[tuple], open_leaves: np.ndarray, seed: int):
    """(row number, class, features) to the bagged rows of each (tree, leaf),
    features as bins; a batch's rows of a leaf travel as one."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, y = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint8)
            values = values_of(b, 2)
            x = bins_of(values, points)
            out: list[tuple] = []
            for tree, route in enumerate(routes):
                count, leaf = bag_counts(ids, tree, seed), places(route, values)
                rows = np.flatnonzero((count > 0) & open_leaves[tree, leaf])
                rows = rows[np.argsort(leaf[rows], kind="stable")]
                cuts = np.flatnonzero(np.diff(leaf[rows])) + 1
                out += [(tree, int(leaf[r[0]]), y[r].tobytes(), count[r].tobytes(), x[r].tobytes()) for r in np.split(rows, cuts) if len(r)]
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["tree", "leaf", "y", "n", "x"])

    return deal


def gini(weights: np.ndarray) -> np.ndarray:
    total = weights.sum(1)
    return 1 - (weights ** 2).sum(1) / np.maximum(total, _TINY) ** 2


def best_splits(x, y, n, at, counts, weight, tried, bins, least):
    """Per open node the best of the tried features: gain (0: none), feature, bin,
    and the class counts that go left. ``at`` is each row's node."""
    m, k = counts.shape
    gain, feature, cut, lefts = np.zeros(m), np.full(m, -1), np.zeros(m, np.int64), np.zeros((m, k), np.int64)
    whole, impurity = counts @ weight, gini(counts * weight)
    rows = np.arange(len(x))
    for j in range(tried.shape[1]):
        f = tried[at, j]
        # rows in order of (node, bin, class), their counts in the low bits
        packed = np.sort((((at * bins + x[rows, f]) * k + y) << 6) | n)
        place = (packed >> 6) // k
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        c, cls = packed & 63, (packed >> 6) % k
        sums = np.stack([np.add.reduceat(np.where(cls == q, c, 0), first) for q in range(k)], 1).cumsum(0)
        node, value = place[first] // bins, place[first] % bins
        begin = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1])
        before = np.zeros((m, k), np.int64)
        before[node[begin][1:]] = sums[begin[1:] - 1]
        left = sums - before[node]
        right = counts[node] - left
        share = (left @ weight) / whole[node]
        g = impurity[node] - share * gini(left * weight) - (1 - share) * gini(right * weight)
        g[(left.sum(1) < least) | (right.sum(1) < max(least, 1))] = 0
        top = np.maximum.reduceat(g, begin)
        at_top = np.flatnonzero(g == np.repeat(top, np.diff(np.append(begin, len(g)))))
        winner = at_top[np.concatenate([[True], np.diff(node[at_top]) > 0])]
        won = winner[top > np.maximum(gain[node[winner]], _TINY)]
        i = node[won]
        gain[i], feature[i], cut[i], lefts[i] = g[won], tried[i, j], value[won], left[won]
    return gain, feature, cut, lefts


def grow(x, y, n, weight, bins, depth, size, least, rng) -> dict[str, np.ndarray]:
    """The nodes of one subtree, parents first; leaves have no children (-1).
    ``x`` bins, ``y`` classes, ``n`` bag counts of the rows."""
    y, n, k = y.astype(np.int64), n.astype(np.int64), len(weight)
    at, counts, levels, start = np.zeros(len(x), np.int64), np.bincount(y, n, k).astype(np.int64)[None], [], 0
    while True:
        m = len(counts)
        level = {"counts": counts, "left": np.full(m, -1), "feature": np.full(m, -1), "cut": np.zeros(m, np.int64), "gain": np.full(m, -1.0)}
        levels.append(level)
        is_open = gini(counts * weight) > _TINY
        if depth <= 0 or not is_open.any():
            break
        keep = is_open[at]
        number = np.cumsum(is_open) - 1
        x, y, n, at = x[keep], y[keep], n[keep], number[at[keep]]
        some = np.flatnonzero(is_open)
        tried = np.argsort(rng.random((m, x.shape[1])), axis=1)[some, :size]
        gain, feature, cut, lefts = best_splits(x, y, n, at, counts[some], weight, tried, bins, least)
        split = gain > 0
        if not split.any():
            break
        rank, inner = np.cumsum(split) - 1, some[split]
        level["left"][inner] = start + m + 2 * rank[split]
        level["feature"][inner], level["cut"][inner], level["gain"][inner] = feature[split], cut[split], gain[split]
        counts = np.stack([lefts[split], counts[inner] - lefts[split]], 1).reshape(-1, k)
        keep = split[at]
        x, y, n, at = x[keep], y[keep], n[keep], at[keep]
        at = 2 * rank[at] + (x[np.arange(len(x)), feature[at]] > cut[at])
        start, depth = start + m, depth - 1
    return pruned({c: np.concatenate([v[c] for v in levels]) for c in levels[0]}, [len(v["left"]) for v in levels], weight)


def pruned(nodes: dict[str, np.ndarray], sizes: list[int], weight: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes without the splits whose two leaves predict the same class."""
    says, keep, left = (nodes["counts"] * weight).argmax(1), np.ones(len(nodes["left"]), bool), nodes["left"]
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes)[::-1], ends[::-1]):
        inner = a + np.flatnonzero(left[a:b] >= 0)
        one, two = left[inner], left[inner] + 1
        gone = (left[one] < 0) & (left[two] < 0) & (says[one] == says[two])
        keep[one[gone]] = keep[two[gone]] = False
        left[inner[gone]] = -1
    name = np.cumsum(keep) - 1
    left = np.where(left >= 0, name[left], -1)
    out = {c: v[keep] for c, v in (nodes | {"left": left, "says": says}).items()}
    return out | {"right": np.where(out["left"] >= 0, out["left"] + 1, -1)}


def packed(tree: int, leaf: int, nodes: dict[str, np.ndarray]) -> pa.Table:
    """A subtree as one row."""
    row = {"tree": [tree], "leaf": [leaf], "nodes": [len(nodes["left"])]} | {c: [nodes[c].astype(t).tobytes()] for c, t in _TYPES.items()}
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * len(_TYPES)]
    return pa.table([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))


def grower(points, weight, depths, bins, size, least, seed):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, leaf = (v.as_py() for v in key)
        y, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8) for c in ("y", "n"))
        x = b"".join(table.column("x").to_pylist())
        x = np.frombuffer(x, np.uint8 if len(x) == len(y) * len(points) else np.uint16).reshape(len(y), -1)
        return packed(tree, leaf, grow(x, y, n, weight, bins, depths[tree, leaf], size, least, np.random.default_rng([seed, tree, leaf])))

    return run


def unpacker(points, weight, most: int = 50_000):
    """Rows of ``PACKED`` to rows of ``SUBTREE``, one for each node."""
    edges = np.full((len(points) + 1, 1 + max(map(len, points), default=0)), np.nan)
    for i, p in enumerate(points):
        edges[i, :len(p)] = p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            whole = {c: np.frombuffer(row[c], t) for c, t in _TYPES.items()}
            whole["counts"] = whole["counts"].reshape(-1, len(weight))
            for a in range(0, row["nodes"], most):
                t = {c: v[a:a + most] for c, v in whole.items()}
                m, leaves, stats = len(t["left"]), t["left"] < 0, t["counts"] * weight
                left = t["left"].astype(np.int64)
                columns = {
                    "tree": np.full(m, row["tree"], np.int32), "leaf": np.full(m, row["leaf"], np.int32), "node": np.arange(a, a + m),
                    "left": left, "right": np.where(leaves, -1, left + 1), "prediction": t["says"].astype(float), "impurity": gini(stats),
                    "stats": pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * len(weight), pa.int32()), pa.array(stats.ravel())),
                    "raw": t["counts"].sum(1), "gain": np.where(leaves, -1.0, t["gain"]), "feature": np.where(leaves, -1, t["feature"]).astype(np.int32),
                    "threshold": pa.array(edges[t["feature"], t["cut"]], mask=leaves)}
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values()], names=list(columns))

    return run


@dataclass
class Node:
    """A node of a top, in the form that MLlib saves, with its depth; ``leaf`` is the
    number of a leaf in its tree, ``grows`` says whether a subtree takes its place."""
    id: int
    prediction: float
    impurity: float
    stats: np.ndarray
    raw: int
    gain: float
    left: int
    right: int
    feature: int
    threshold: float | None
    depth: int = 0
    leaf: int = -1
    grows: bool = False


def read_tops(nodes: DataFrame, max_depth: int) -> list[list[Node]]:
    """The nodes of every tree of the top, at most 2 ** (TOP_DEPTH + 1) for each tree."""
    n = F.col("nodeData")
    rows = nodes.select("treeID", n["id"], n["prediction"], n["impurity"], n["impurityStats"], n["rawCount"], n["gain"], n["leftChild"],
                        n["rightChild"], n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"]).collect()
    tops: list[list[Node]] = [[] for _ in range(1 + max(r[0] for r in rows))]
    for tree, *fields, stats, raw, gain, left, right, feature, threshold in sorted(rows, key=lambda r: r[:2]):
        tops[tree].append(Node(*fields, np.array(stats), raw, gain, left, right, feature, threshold[0] if left >= 0 else None))
    for top in tops:
        leaves = 0
        for node in top:  # parents come first
            if node.left >= 0:
                top[node.left].depth = top[node.right].depth = node.depth + 1
            else:
                node.leaf, node.grows = leaves, node.impurity > _TINY and node.depth < max_depth
                leaves += 1
    return tops


def routes_of(tops: list[list[Node]]) -> list[tuple]:
    """What ``places`` needs of each tree: arrays by node, leaves lead to themselves."""
    out = []
    for top in tops:
        inner = np.array([n.left >= 0 for n in top])
        ids = np.arange(len(top))
        side = lambda c: np.where(inner, [getattr(n, c) for n in top], ids)
        out.append((np.array([max(n.feature, 0) for n in top]), np.array([0.0 if n.threshold is None else n.threshold for n in top]),
                    side("left"), side("right"), np.array([n.leaf for n in top]), max(n.depth for n in top)))
    return out


def counter(points, routes, some: list[tuple[int, int]], tried: np.ndarray, bins: int, classes: int, seed: int):
    """(row number, class, features) to the class counts of the tried features' bins
    in the leaves ``some``: one row for each leaf of a task."""
    trees: dict[int, list[int]] = {}
    for i, (tree, _) in enumerate(some):
        trees.setdefault(tree, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = tried.shape[1]
        sums = np.zeros((len(some), size, bins * classes), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            ids, y = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
            values = values_of(b, 2)
            x = bins_of(values, points)
            for tree, mine in trees.items():
                at = np.full(1 + routes[tree][4].max(), -1)
                at[[some[i][1] for i in mine]] = np.arange(len(mine))
                count, here = bag_counts(ids, tree, seed), at[places(routes[tree], values)]
                rows = np.flatnonzero((count > 0) & (here >= 0))
                here, n = here[rows], count[rows]
                for j in range(size):
                    f = tried[mine, j][here]
                    place = (here * bins + x[rows, f]) * classes + y[rows]
                    sums[mine, j] += np.bincount(place, n, len(mine) * bins * classes).astype(np.int64).reshape(len(mine), -1)
        found = np.flatnonzero(sums.any(axis=(1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array([sums[i].tobytes() for i in found], pa.binary())], ["at", "sums"])

    return run


def chooser(weight, tried, bins, least):
    """The tasks' counts of a leaf to its best split, as ``best_splits`` finds it."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        k, (i,) = len(weight), (v.as_py() for v in key)
        sums = sum(np.frombuffer(v.as_py(), np.int64) for v in table.column("sums")).reshape(-1, bins, k)
        counts, left = sums[0].sum(0), sums.cumsum(1)[:, :-1]
        right = counts - left
        share = left @ weight / (counts @ weight)
        of = lambda c: gini((c * weight).reshape(-1, k)).reshape(share.shape)
        gain = gini(counts[None] * weight) - share * of(left) - (1 - share) * of(right)
        gain[np.minimum(left.sum(2), right.sum(2)) < max(least, 1)] = 0
        j, cut = np.unravel_index(gain.argmax(), gain.shape)
        row = [i, float(gain[j, cut]), int(tried[i, j]), int(cut), left[j, cut].tolist(), counts.tolist()]
        types = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table([pa.array([v], t) for v, t in zip(row, types)], names=["at", "gain", "feature", "cut", "lefts", "counts"])

    return run


def widened(tops: list[list[Node]], rows: DataFrame, points, weight, bins, size, p) -> None:
    """Splits the leaves of the tops that more than ``GROUP_ROWS`` rows are in, in
    place, a level in each pass over ``rows`` (number, class, features)."""
    def become(node: Node, counts: np.ndarray) -> None:
        node.stats, node.raw = counts * weight, int(counts.sum())
        node.prediction, node.impurity = float(node.stats.argmax()), float(gini(node.stats[None])[0])
        node.grows = node.impurity > _TINY and node.depth < p.max_depth

    while big := [(tree, n) for tree, top in enumerate(tops) for n in top if n.grows and n.raw > GROUP_ROWS][:PASS_NODES]:
        some = [(tree, n.leaf) for tree, n in big]
        tried = np.stack([np.random.default_rng([p.seed, tree, leaf, 1]).permutation(len(points))[:size] for tree, leaf in some])
        sums = rows.mapInArrow(counter(points, routes_of(tops), some, tried, bins, len(weight), p.seed), "at int, sums binary")
        found = sums.groupBy("at").applyInArrow(
            chooser(weight, tried, bins, p.min_instances_per_node), "at int, gain double, feature int, cut int, lefts array<long>, counts array<long>").collect()
        splits = {r["at"]: r for r in found}
        for i, (tree, node) in enumerate(big):
            top, r = tops[tree], splits.get(i)
            if r is None:  # no row of the bag is here
                node.grows = False
                continue
            counts, lefts = np.array(r.counts), np.array(r.lefts)
            become(node, counts)
            if r.gain <= _TINY:
                node.grows = False
            if not node.grows:
                continue
            leaves = 1 + max(n.leaf for n in top)
            node.left, node.right, node.feature, node.threshold, node.gain = len(top), len(top) + 1, r.feature, float(points[r.feature][r.cut]), r.gain
            for side, part in enumerate((lefts, counts - lefts)):
                child = Node(len(top), 0.0, 0.0, part, 0, -1.0, -1, -1, -1, None, node.depth + 1, leaves + side)
                become(child, part)
                top.append(child)
            node.leaf, node.grows = -1, False


def finished(top: PipelineModel, rows: DataFrame, features: list[str], label: str, weight_col: str, p) -> StoredForest:
    """``top`` with its impure leaves grown on to ``p.max_depth``. ``rows`` has the
    features, class, weight and row number. The forest is put together as a table
    of nodes in the form that MLlib saves, and is never loaded here."""
    spark, (_, forest) = rows.sparkSession, top.stages
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores/forest-{uuid.uuid4().hex}"
    weight = np.ones(forest.numClasses)
    for r in rows.groupBy(label).agg(F.max(weight_col).alias("w")).collect():  # one row for each class
        weight[int(r[0])] = r.w
    points = split_points(rows, features, p.max_bins)
    bins, size = max(2, 1 + max(map(len, points))), subset_size(p.feature_subset, len(features))
    forest.set(forest.maxDepth, p.max_depth)
    top.write().save(path)
    data = f"{path}/stages/1_{forest.uid}/data"
    nodes = spark.read.parquet(data)
    kind, tops = nodes.schema, read_tops(nodes, p.max_depth)
    numbered = rows.select(ROW, label, *[f"`{f}`" for f in features])
    widened(tops, numbered, points, weight, bins, size, p)
    leaves = [(tree, n) for tree, t in enumerate(tops) for n in t if n.left < 0]
    open_leaves = np.zeros((p.num_trees, 1 + max(n.leaf for _, n in leaves)), bool)
    depths = np.zeros(open_leaves.shape, np.int64)
    for tree, n in leaves:
        open_leaves[tree, n.leaf], depths[tree, n.leaf] = n.grows, p.max_depth - n.depth
    routes = routes_of(tops)
    bags = numbered.mapInArrow(dealer(points, routes, open_leaves, p.seed), "tree int, leaf int, y binary, n binary, x binary")
    # small rows, much work: dealt to a task for each tree's worth, whatever their bytes
    tasks = max(p.num_trees, sum(t[0].raw for t in tops) // GROUP_ROWS)
    made = grower(points, weight, depths, bins, size, p.min_instances_per_node, p.seed)
    whole = stored(bags.repartition(tasks, "tree", "leaf").groupBy("tree", "leaf").applyInArrow(made, PACKED), "subtrees")
    # a subtree's root takes the place of its leaf; its other nodes are numbered on from the top's
    before = Window.partitionBy("tree").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    places_of = spark.createDataFrame([(tree, n.leaf, n.id, len(tops[tree])) for tree, n in leaves], "tree int, leaf int, at int, size long")
    places_of = whole.select("tree", "leaf", F.col("nodes").alias("n")).join(places_of, ["tree", "leaf"]).withColumn(
        "first", F.col("size") - 1 + F.coalesce(F.sum(F.col("n") - 1).over(before), F.lit(0)))
    named = lambda c: F.when(F.col(c) < 0, F.lit(-1)).when(F.col(c) == 0, F.col("at")).otherwise(F.col("first") + F.col(c)).cast("int")
    is_leaf = F.col("left") < 0
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(is_leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias(
        "leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    fields = {"id": named("node"), "prediction": F.col("prediction"), "impurity": F.col("impurity"), "impurityStats": F.col("stats"), "rawCount": F.col("raw"),
              "gain": F.col("gain"), "leftChild": named("left"), "rightChild": named("right"), "split": split}
    of_node = kind["nodeData"].dataType
    grown = whole.mapInArrow(unpacker(points, weight), SUBTREE).join(places_of.drop("n", "size"), ["tree", "leaf"]).select(
        F.col("tree").cast(kind["treeID"].dataType).alias("treeID"), F.struct(*[fields[c].alias(c) for c in of_node.names]).cast(of_node).alias("nodeData"))
    taken = {(r.tree, r["at"]) for r in places_of.select("tree", "at").collect()}
    kept = spark.createDataFrame([(tree, n.id, n.prediction, n.impurity, n.stats.tolist(), n.raw, n.gain, n.left, n.right, n.feature, n.threshold)
                                  for tree, t in enumerate(tops) for n in t if (tree, n.id) not in taken],
                                 "tree int, node int, prediction double, impurity double, stats array<double>, raw long, gain double, left int, right int, "
                                 "feature int, threshold double")
    plain = fields | {"id": F.col("node"), "leftChild": F.col("left"), "rightChild": F.col("right")}
    kept = kept.select(F.col("tree").cast(kind["treeID"].dataType).alias("treeID"), F.struct(*[plain[c].alias(c) for c in of_node.names]).cast(of_node).alias("nodeData"))
    kept.unionByName(grown).write.mode("overwrite").parquet(data)
    stats = {(tree, n.leaf): n.stats for tree, n in leaves}
    return StoredForest(top, path, data, features, points, weight, routes, stats, whole)
