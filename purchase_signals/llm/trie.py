"""Prefix trie of conversations by range minima over sorted LCPs.

A conversation is the sequence of its turns; a turn is a 16-byte digest of role
and text.  All sequences are sorted (range partitions, ties by conversation id),
equal ones beside each other become one row with a count, and each row knows the
length of the prefix it shares with the row before (its LCP).  Every candidate
prefix (row, depth) finds its members by two independent binary searches, left
and right, over a sparse table of range minima: the furthest rows that all LCPs
in between are at least as long as the prefix.  Counts, smallest ids, children,
leaves and sums over subtrees are then differences of prefix sums.  There is no
stack and no recursion.

Rows are searched in blocks of bounded size, each on its own.  Only prefixes that
the neighbouring blocks share can have members in several blocks; these nodes, at
most the depth of a conversation per block edge, carry a digest of their prefix
and are merged by it.  Texts never leave the first projection, and the only value
that gathers a node's members, the digest of their ids, is streamed from pieces.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, stage

#: Bytes of a turn's digest.
WIDTH = 16
#: Rows and turns of one block, at most (one row more may pass the second).
BLOCK_ROWS = 16384
BLOCK_TURNS = 262144
#: Ids of one piece of a large group of equal sequences.
PIECE_IDS = 50000
#: LCP towards a neighbour that is not known yet, and where there is none.
UNKNOWN, NONE = -2, -1
NOBODY = hashlib.sha256(b"").hexdigest()

RUNS = ("part int, block int, first binary, last binary, left int, right int, lcp binary, length binary, n binary, least binary, "
        "ends binary, is_open binary, points binary, piece_key binary, piece_first long, piece_ids binary")
NODES = ("part int, block int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved long, points long, "
         "ends binary, key binary, crossing boolean, on_left boolean, parent_conv long, parent_key binary")


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, digests as hex, code points of the texts), one row per
    conversation, in order of turn (null first, ties by digest).  Null role or
    text counts as empty; rows without conversation id belong to none."""
    role, text = F.coalesce(turns[role_col].cast("string"), F.lit("")), F.coalesce(turns[text_col].cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    one = turns.select(turns[conv_col].cast("long").alias("conv_id"), F.struct(
        turns[turn_col].cast("long").alias("turn"), digest.alias("d"), F.char_length(text).alias("points")).alias("t"))
    listed = one.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.col("t.d").alias("digests"), F.col("t.points").alias("points"))


def with_shared_heads(seqs: DataFrame, base: Column, length: Column, longest: int) -> DataFrame:
    """Every sequence's first ``length`` (at most ``longest``) turns replaced by
    those of conversation ``base`` (fewer if it has fewer, none if it is absent)."""
    heads = seqs.select(F.col("conv_id").alias("base"), F.slice("digests", 1, longest).alias("hd"), F.slice("points", 1, longest).alias("hp"))
    both = seqs.withColumn("base", base).withColumn("h", length.cast("int")).join(heads, "base", "left")

    def joined(head: str, own: str) -> Column:
        first = F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.slice(own, F.lit(1), F.lit(0)))
        return F.concat(first, F.slice(own, F.col("h") + 1, F.greatest(F.size(own), F.lit(1))))

    return both.select("conv_id", joined("hd", "digests").alias("digests"), joined("hp", "points").alias("points"))


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // WIDTH


@dataclass
class Block:
    """Rows of a sorted run that are searched together."""
    left: int
    lcp: list = field(default_factory=list)
    length: list = field(default_factory=list)
    n: list = field(default_factory=list)
    least: list = field(default_factory=list)
    ends: list = field(default_factory=list)
    is_open: list = field(default_factory=list)
    points: list = field(default_factory=list)
    first: bytes = b""
    last: bytes = b""
    turns: int = 0

    def row(self, part: int, number: int, right: int) -> tuple:
        arrays = (np.array(self.lcp, np.int32), np.array(self.length, np.int32), np.array(self.n, np.int64), np.array(self.least, np.int64))
        return (part, number, self.first, self.last, self.left, right, *(a.tobytes() for a in arrays), b"".join(self.ends),
                np.array(self.is_open, np.uint8).tobytes(), np.concatenate(self.points).astype(np.int64).tobytes(), None, None, None)


class Run:
    """One task's sorted rows, folded into blocks and pieces of ids.

    The first and last group of equal sequences may go on in the neighbouring
    tasks, and a group of more than ``piece_ids`` members is not held: those leave
    their ids as pieces, under the digest of their sequence."""

    def __init__(self, part: int, block_rows: int, piece_ids: int):
        self.block_rows, self.piece_ids = block_rows, piece_ids
        self.part, self.out, self.number, self.block = part, [], 0, None
        self.seq, self.before, self.ids, self.n, self.in_pieces = None, None, [], 0, True

    def add(self, conv_id: int, seq: bytes, points) -> None:
        if seq != self.seq:
            if self.seq is not None:
                self.close()
            self.before, self.seq, self.points = self.seq, seq, points
            self.ids, self.n, self.least = [], 0, conv_id
            self.in_pieces = self.before is None
        elif len(self.ids) >= self.piece_ids:
            self.in_pieces = True
            self.piece()
        self.ids.append(conv_id)
        self.n += 1

    def piece(self) -> None:
        key = hashlib.sha256(self.seq).digest()
        self.out.append((self.part, *[None] * 12, key, self.ids[0], ",".join(map(str, self.ids)).encode()))
        self.ids = []

    def close(self, last: bool = False) -> None:
        """The group at hand becomes a row."""
        lcp = common_turns(self.before, self.seq) if self.before is not None else UNKNOWN
        b = self.block
        if b is not None and (len(b.lcp) >= self.block_rows or b.turns >= BLOCK_TURNS):
            self.flush(lcp)
            b = None
        if b is None:
            b = self.block = Block(lcp, first=self.seq)
        is_open = self.in_pieces or last
        b.lcp.append(lcp)
        b.length.append(len(self.seq) // WIDTH)
        b.n.append(self.n)
        b.least.append(self.least)
        b.is_open.append(is_open)
        b.ends.append(hashlib.sha256(self.seq if is_open else ",".join(map(str, self.ids)).encode()).digest())
        # the first row of a block stands for all its prefixes, others for those they do not share
        b.points.append(np.asarray(self.points[0 if len(b.lcp) == 1 else lcp:], np.int64))
        b.turns += len(b.points[-1])
        b.last = self.seq
        if is_open:
            self.piece()

    def flush(self, right: int) -> None:
        self.out.append(self.block.row(self.part, self.number, right))
        self.number += 1
        self.block = None

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = [c.split()[0] for c in RUNS.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in RUNS.split(", ")]
        cols = list(zip(*rows)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def folder(block_rows: int, piece_ids: int):
    def fold(batches):
        run = Run(TaskContext.get().partitionId(), block_rows, piece_ids)
        for batch in batches:
            points = batch.column("points").to_pylist()
            for i, (conv_id, seq) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("seq").to_pylist())):
                run.add(conv_id, seq, points[i])
            if run.out:
                yield run.taken()
        if run.seq is not None:
            run.close(last=True)
            run.flush(UNKNOWN)
            yield run.taken()

    return fold


class Minima:
    """Sparse table: level k holds the minima of all windows of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.levels, self.n = [values], len(values)
        while 2 << (len(self.levels) - 1) <= self.n:
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo..hi], both inclusive."""
        k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for level, table in enumerate(self.levels):
            at = np.flatnonzero(k == level)
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << level) + 1])
        return out

    def last_right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row reached from ``row`` over values of at least ``depth``
        (value i lies between rows i - 1 and i); binary search by halving windows."""
        at = row.copy()
        for level in reversed(range(len(self.levels))):
            step, table = 1 << level, self.levels[level]
            fits = at + step < self.n
            window = np.where(fits, at + 1, 0)
            at = np.where(fits & (table[np.minimum(window, len(table) - 1)] >= depth), at + step, at)
        return at

    def last_left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row reached from ``row`` leftwards in the same way."""
        at = row.copy()
        for level in reversed(range(len(self.levels))):
            step, table = 1 << level, self.levels[level]
            fits = at - step >= 0
            window = np.where(fits, at - step + 1, 0)
            at = np.where(fits & (table[np.minimum(window, len(table) - 1)] >= depth), at - step, at)
        return at


def chain(seq: bytes, deepest: int) -> list[bytes]:
    """Digests of a sequence's prefixes of depth 0 to ``deepest``."""
    h, out = hashlib.sha256(), []
    for d in range(deepest + 1):
        if d:
            h.update(seq[(d - 1) * WIDTH:d * WIDTH])
        out.append(h.copy().digest())
    return out


def block_nodes(row: dict) -> pa.RecordBatch:
    """The nodes that have members in one block, with what the block knows of them."""
    left, right = row["left"], row["right"]
    lcp = np.frombuffer(row["lcp"], np.int32).astype(np.int64)
    length, n = np.frombuffer(row["length"], np.int32).astype(np.int64), np.frombuffer(row["n"], np.int64)
    lcp[0] = left
    rows = len(lcp)
    start = np.where(np.arange(rows) > 0, lcp + 1, 0)
    each = length - start + 1
    end = np.cumsum(each)
    j = np.repeat(np.arange(rows), each)
    idx = np.arange(len(j))
    depth = idx - (end - each)[j] + start[j]
    minima = Minima(lcp)
    r, l = minima.last_right(j, depth), minima.last_left(j, depth)
    upto = np.concatenate(([0], np.cumsum(n)))
    members = upto[r + 1] - upto[l]
    least = Minima(np.frombuffer(row["least"], np.int64)).of(l, r)
    leaf = np.append(lcp[1:], right) < length
    leaves = np.concatenate(([0], np.cumsum(leaf)))
    at_depth = np.sort(lcp[1:] * rows + np.arange(1, rows))
    children = np.searchsorted(at_depth, depth * rows + r, "right") - np.searchsorted(at_depth, depth * rows + l, "right")
    children = children + ((lcp[l] <= depth) & (length[l] > depth))
    # texts in the order of the candidates of depth 1 and more
    points = np.zeros(len(j), np.int64)
    points[depth > 0] = np.frombuffer(row["points"], np.int64)
    on_left = (j == 0) & (depth <= left)
    on_right = (r == rows - 1) & (depth <= right)
    crossing = on_left | on_right
    own = np.where(crossing, 0, (members - 1) * points)
    total = np.concatenate(([0], np.cumsum(own)))
    saved = total[end[r]] - total[idx]
    # the parent is the candidate before, or that of the first row sharing the LCP
    parent = idx - 1
    new = np.flatnonzero((depth == start[j]) & (depth > 0))
    first = minima.last_left(j[new], depth[new] - 1)
    parent[new] = (end - each)[first] + depth[new] - 1 - start[first]
    keys: list = [None] * len(j)
    from_left, from_right = chain(row["first"], left), chain(row["last"], right)
    for i in np.flatnonzero(crossing):
        keys[i] = from_left[depth[i]] if on_left[i] else from_right[depth[i]]
    ends: list = [None] * len(j)
    digests, is_open = row["ends"], np.frombuffer(row["is_open"], np.uint8)
    merged = list(keys)
    for i in np.flatnonzero(depth == length[j]):
        digest = digests[32 * j[i]:32 * j[i] + 32]
        if is_open[j[i]]:
            merged[i] = digest
        else:
            ends[i] = digest
    known = (depth > 0) & ~crossing[parent]
    parents = least[parent]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(j), row["part"], np.int32)), pa.array(np.full(len(j), row["block"], np.int32)), pa.array(depth.astype(np.int32)),
        pa.array(least), pa.array(members), pa.array(children.astype(np.int64)), pa.array(leaves[r + 1] - leaves[l]), pa.array(saved),
        pa.array(points), pa.array(ends, pa.binary()), pa.array(merged, pa.binary()), pa.array(crossing), pa.array(on_left),
        pa.array(parents, mask=~known), pa.array([None if k or d == 0 else keys[p] for k, d, p in zip(known, depth, parent)], pa.binary())],
        [c.split()[0] for c in NODES.split(", ")])


def search(batches):
    for batch in batches:
        for row in batch.to_pylist():
            out = block_nodes(row)
            for at in range(0, out.num_rows, 65536):
                yield out.slice(at, 65536)


def piece_ends(batches):
    """(key, digest of the ids) of pieces sorted by key and first id."""
    key, h, out = None, None, ([], [])
    for batch in batches:
        for k, ids in zip(batch.column("piece_key").to_pylist(), batch.column("piece_ids").to_pylist()):
            if k != key:
                if key is not None:
                    out[0].append(key), out[1].append(h.digest())
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids)
    if key is not None:
        out[0].append(key), out[1].append(h.digest())
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["key", "whole"])


@F.pandas_udf(T.IntegerType())
def shared(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([NONE if x is None or y is None else common_turns(x, y) for x, y in zip(a, b)], dtype="int32")


def prefix_trie(seqs: DataFrame, block_rows: int = BLOCK_ROWS, piece_ids: int = PIECE_IDS) -> DataFrame:
    """Nodes of the trie over ``seqs`` (conv_id, digests, points), one row per
    distinct prefix: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation without turns is a member of the root alone; no conversations
    give no nodes.  Rows repeated under one conversation id are members each.
    """
    prepare(seqs.sparkSession)
    rows = stage(seqs.select("conv_id", F.unhex(F.array_join("digests", "")).alias("seq"), "points"), "sequences")
    ordered = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    runs = stage(ordered.mapInArrow(folder(block_rows, piece_ids), RUNS), "runs")
    # one row for each non-empty partition of the sort
    blocks = runs.where("block IS NOT NULL")
    edges = blocks.groupBy("part").agg(F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"), F.max("block").alias("top"))
    edges = edges.selectExpr("part", "top", "first", "last", "lag(last) OVER (ORDER BY part) AS last_before", "lead(first) OVER (ORDER BY part) AS first_after")
    edges = edges.select("part", "top", shared("last_before", "first").alias("l"), shared("last", "first_after").alias("r"))
    known = blocks.join(F.broadcast(edges), "part").withColumns({
        "left": F.when(F.col("block") == 0, F.col("l")).otherwise(F.col("left")),
        "right": F.when(F.col("block") == F.col("top"), F.col("r")).otherwise(F.col("right"))})
    inputs = ["part", "block", "first", "last", "left", "right", "lcp", "length", "n", "least", "ends", "is_open", "points"]
    nodes = stage(known.select(*inputs).mapInArrow(search, NODES), "nodes")

    pieces = runs.where("piece_key IS NOT NULL").select("piece_key", "piece_first", "piece_ids")
    whole = pieces.repartition("piece_key").sortWithinPartitions("piece_key", "piece_first").mapInArrow(piece_ends, "key binary, whole binary")
    place = F.struct("part", "block")
    met = nodes.where("key IS NOT NULL").groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("points").alias("points"), F.max("ends").alias("ends"), F.min(F.when(F.col("on_left"), place)).alias("home"),
        F.max("parent_key").alias("parent_key"), F.max("parent_conv").alias("parent_conv"))
    met = stage(met.withColumn("own", F.when(F.col("home").isNotNull(), (F.col("n_convs") - 1) * F.col("points")).otherwise(F.lit(0))), "met")
    # a shared node adds its own share to those above it on the edge that is its home
    edge = nodes.where("on_left").select("part", "block", "depth", "key").join(met.select("key", "own", "home"), "key")
    edge = edge.withColumn("own", F.when(F.col("home") == place, F.col("own")).otherwise(F.lit(0)))
    below = edge.selectExpr("key", "sum(own) OVER (PARTITION BY part, block ORDER BY depth DESC) AS below").groupBy("key").agg(F.sum("below").alias("below"))
    met_ids = met.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("met_conv"))
    merged = met.join(below, "key", "left").join(whole, "key", "left").join(met_ids, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv", "met_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("saved") + F.coalesce("below", F.lit(0))).alias("saved_tokens"), F.coalesce("ends", "whole").alias("ends"))
    # the parents of a block's own nodes, by block, so that no key meets more rows than a block has
    above = nodes.where("crossing").select("part", "block", "key").join(met.select("key", F.col("conv_id").alias("met_conv")), "key")
    above = above.select("part", "block", F.col("key").alias("parent_key"), "met_conv")
    inner = nodes.where("key IS NULL").join(above, ["part", "block", "parent_key"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv", "met_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends")
    out = merged.unionByName(inner)
    counts = [F.col(c).cast("long").alias(c) for c in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return out.select("conv_id", *counts, F.coalesce(F.lower(F.hex("ends")), F.lit(NOBODY)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The trie of a table of turns as it is; other columns are ignored."""
    prepare(turns.sparkSession)
    return prefix_trie(sequences(turns, conv_col, turn_col, role_col, text_col))
