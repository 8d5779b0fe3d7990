import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from purchase_signals.llm import trie
from purchase_signals.llm.queries import QUERIES


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(seqs):
    """Nodes by listing every prefix of every conversation."""
    members = {}
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        saved[p] = own + sum(saved[k] for k in kids.get(p, []))
    out = []
    for p, ms in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ms if len(seqs[c]) == len(p)))
        out.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    assert df.columns == COLS and all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet'").fetchall()
    assert found(QUERIES["op12_prefix_trie"](spark, path)) == brute(rebuilt(rows))


def made(seed, n):
    """Conversations over few turns: shared heads, copies, prefixes of others."""
    rnd, rows = random.Random(seed), []
    for c in range(n):
        kind = rnd.random()
        turns = ["a"] * 3 if kind < 0.4 else ["a"] * rnd.randrange(1, 6) if kind < 0.5 else [rnd.choice("abc") for _ in range(rnd.randrange(1, 8))]
        rows += [(c, i, "u", t * 2) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("block,piece", [(1, 1), (3, 2), (7, 5), (16384, 50000)])
def test_nodes_over_block_and_task_edges(spark, block, piece):
    """Small blocks, many tasks, copies in a third of all conversations."""
    rows = made(block, 300)
    seqs = {}
    for c, _, role, text in rows:
        seqs.setdefault(c, []).append((role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(trie.prefix_trie(trie.sequences(df), block, piece)) == brute(seqs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_edge_rows(spark):
    """Null ids, turns, roles and texts, ties, repeated rows, long texts, clashing names."""
    rows = [(None, 1, "u", "x"), (5, None, None, "n"), (5, 1, "u", None), (5, 1, "u", ""), (100, 2, "u", "é" * 70000), (100, 1, "a", "b"),
            (100, 1, "a", "b"), (101, 1, "q", "r"), (205, 0, "z", "z"), (-5, 0, "z", "z"), (107, 3, "", ""), (107, 3, None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, seq int, part int, depth int")
    own = trie.sequences(df)
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    got = found(trie.prefix_trie(trie.with_shared_heads(own, F.col("conv_id") - F.col("conv_id") % 100, heads, 5)))
    want = brute(rebuilt(rows))
    # turns of one conversation that tie are ordered by digest, so compare what their order does not change
    drop = lambda nodes: sorted((d, n) for _, d, _, n, *_ in nodes)
    assert drop(got) == drop(want)
    assert got[0][1] == 0 or any(g[1] == 0 and g[3] == len(rebuilt(rows)) for g in got)
    assert found(trie.conversation_trie(df.where("false"))) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    seqs = spark.createDataFrame([(1, [], []), (2, [], [])], "conv_id long, digests array<string>, points array<int>")
    assert found(trie.prefix_trie(seqs)) == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())]


def test_minima():
    rnd = np.random.default_rng(1)
    v = rnd.integers(0, 9, 57)
    m = trie.Minima(v)
    lo = rnd.integers(0, 57, 200)
    hi = np.array([rnd.integers(a, 57) for a in lo])
    assert (m.of(lo, hi) == [v[a:b + 1].min() for a, b in zip(lo, hi)]).all()
    depth = rnd.integers(0, 9, 200)
    right = [next((j - 1 for j in range(a + 1, 57) if v[j] < d), 56) for a, d in zip(lo, depth)]
    left = [next((j for j in range(a, 0, -1) if v[j] < d), 0) for a, d in zip(lo, depth)]
    assert (m.last_right(lo, depth) == right).all() and (m.last_left(lo, depth) == left).all()
