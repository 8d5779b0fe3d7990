import random
import re

import duckdb
import numpy as np
import pytest

from purchase_signals.llm import jaccard as J
from purchase_signals.llm import shingles
from purchase_signals.llm.queries import QUERIES


def shingle_set(text):
    low = (text or "").encode()
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in low)
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(texts):
    """doc_id -> (set size, component) by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    overlap = {}
    for h in holders.values():
        for k, a in enumerate(h):
            for b in h[k + 1:]:
                overlap[a, b] = overlap.get((a, b), 0) + 1
    for (a, b), n in overlap.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


def check(spark, texts, parts=4):
    df = spark.createDataFrame([(i, t, 0, b"") for i, t in texts.items()], "doc_id long, text string, n long, bytes binary")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df.repartition(parts)).collect()}
    want = brute(texts)
    assert {i: (v, want[i]) for i, v in got.items() if v != want[i]} == {} and len(got) == len(want)
    return want


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


def test_shingle_sets():
    texts = ["", " \t\n", "a", "A b\x0bC d", "a B c d E f a b c d e f", "é É x y z w q", "w " * 50]
    got = shingles.sets([np.frombuffer(t.encode(), np.uint8) for t in texts])
    assert [len(g) for g in got] == [len(shingle_set(t)) for t in texts]
    long = " ".join(f"w{i % 997}" for i in range(400000))
    one = shingles.sets([np.frombuffer(x.encode(), np.uint8) for x in ("q r s t u", long, "Q R S T U ")])
    assert len(one[1]) == 997 and one[0].tolist() == one[2].tolist()


def test_planted_near_copies_equal_brute_force(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") + rng.choice("lmnrst")
    make = lambda n: [word() for _ in range(n)]
    passage, base, chain = make(60), make(120), make(200)
    texts = {0: None, 1: "", 2: " \n", 3: "one two", 4: "One\ttwo", 5: "one two three"}
    k = 6
    for _ in range(40):  # a passage many documents share, in texts of their own
        texts[k] = " ".join(make(rng.randrange(5, 120)) + passage + make(rng.randrange(5, 90)))
        k += 1
    for e in range(60):  # near copies on both sides of the threshold
        texts[k] = near(rng, base, e % 7)
        k += 1
    for e in range(25):  # a chain: neighbours link, ends do not
        texts[k] = " ".join(chain[e * 4:e * 4 + 100])
        k += 1
    for _ in range(30):
        texts[k] = " ".join(make(rng.randrange(1, 9)))
        k += 1
    texts[k] = texts[k + 1] = texts[50]
    want = check(spark, texts)
    assert len({c for _, c in want.values()}) < len(texts) - 60


@pytest.mark.parametrize("keys", [1, 8])
def test_links_that_min_hashes_miss_are_found_by_the_matrix(spark, monkeypatch, keys):
    monkeypatch.setattr(J, "KEYS", keys)
    monkeypatch.setattr(J, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "COLUMNS", 50)
    rng = random.Random(keys)
    texts, k = {}, 0
    for _ in range(25):
        base = [f"b{rng.random()}" for _ in range(40)]
        for e in (0, 1, 1, 2):
            texts[k] = near(rng, base, e)
            k += 1
    check(spark, texts, parts=7)


def test_threshold_is_exact(spark):
    a = [f"w{i}" for i in range(104)]  # 100 shingles
    texts = {1: " ".join(a), 2: " ".join(a[:79]), 3: " ".join(f"v{i}" for i in range(104)), 4: " ".join(f"v{i}" for i in range(78))}
    want = check(spark, texts)
    assert (want[2][1], want[4][1]) == (1, 4)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_ngram_jaccard"](spark, sf).collect()}
    assert got == brute(texts)


def test_null_ids_repeated_rows_and_empty_table(spark):
    t = "a b c d e f g h i j"
    df = spark.createDataFrame([(None, t), (7, t), (7, t), (9, t + " k"), (None, "solo x y z q"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 6, 7), (7, 6, 7), (7, 6, 7), (9, 7, 7), (None, 1, None), (3, 0, 3)], key=str)
    assert J.jaccard_components(df.limit(0)).count() == 0


def test_one_row_of_each_group_stays_with_repeated_and_null_ids(spark):
    t = "a b c d e f g h i j"
    rows = [(None, t), (7, t), (7, t), (9, t + " k"), (5, t + " k"), (5, "clean text of its own here"), (None, "solo x y z q"), (None, "solo x y z q"),
            (3, None), (3, None)]
    df = spark.createDataFrame([(i, x, k) for k, (i, x) in enumerate(rows)], "doc_id long, text string, first int")
    out = J.one_of_each(df.repartition(4))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(5, t + " k"), (5, "clean text of its own here"), (None, "solo x y z q"), (3, None), (3, None)], key=str)
    lost = J.one_of_each(df.where("first IN (1, 4, 5)").unionByName(df.where("first = 3").selectExpr("2L AS doc_id", "text", "first")))
    assert sorted((r.doc_id, r.text) for r in lost.collect()) == [(2, t + " k"), (5, "clean text of its own here")]
    assert out.columns == df.columns and J.one_of_each(df.limit(0)).count() == 0


def test_unions_of_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(J, "UNION", 50)
    matrix = spark.range(1000).selectExpr("if(id < 990, 1L, 2L) AS h", "id AS t")
    union, parts = J.unions(matrix)
    assert {r.other: r.parts for r in parts.collect()} == {1: 20, 2: 1}
    got = union.collect()
    assert sorted(t for r in got for t in r["union"]) == list(range(1000)) and max(len(r["union"]) for r in got) < 150
    monkeypatch.setattr(J, "UNION", 7)
    monkeypatch.setattr(J, "KEYS", 1)
    rng, texts = random.Random(3), {}
    for k in range(60):
        if k % 4 == 0:
            base = [f"b{rng.random()}" for _ in range(40)]
        texts[k] = near(rng, base, (0, 1, 1, 2)[k % 4])
    check(spark, texts)
