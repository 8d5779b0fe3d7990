import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from purchase_signals.llm import bpe, packing
from purchase_signals.llm.queries import ORACLES, QUERIES

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "a", "It's NAÏVE, isn't it?! 3.14 x_y", "é ́ ΣΑΣ ǅ İ ß", "x\x1cy\x85z    q",
         "\t\n  two  spaces \n", "日本語のテキスト 한국어 🙂👍🏽", "word. " * 3000, "a" * 30000, " " * 30000 + "b", "9" * 5000]


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, bytes string")


def test_round_trip_equals_the_library(spark):
    got = {r.doc_id: r for r in bpe.round_trip(frame(spark, TEXTS), RANKS, P.PATTERN).collect()}
    c = bpe.codec(RANKS, P.PATTERN)
    for i, t in enumerate(TEXTS):
        ids = c.encoding.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_then_decode(spark):
    ids = bpe.encode(frame(spark, TEXTS), RANKS, P.PATTERN)
    out = {r.doc_id: bytes(r.bytes) for r in bpe.decode(ids, RANKS, P.PATTERN).collect()}
    assert out == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("size", [1, 7, 100])
def test_parts_keep_the_matches(size):
    c = bpe.codec(RANKS, P.PATTERN)
    for t in filter(None, TEXTS[:9]):
        cut = list(bpe.parts(t, size))
        assert "".join(cut) == t
        assert [i for p in cut for i in c.encoding.encode_ordinary(p)] == c.encoding.encode_ordinary(t)


def check_pieces(rows, texts, ids_of):
    """Every id once, sequences gapless and at most 4096, ids as the tokenizer gives them."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for d, t in texts.items():
        want = np.array([*ids_of(t or ""), packing.END_ID], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(want[at:at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padding = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WIDTH
        padding += 0 if at & (at - 1) == 0 else packing.WIDTH - at
    return padding


def test_packing_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    t = Tokenizer.from_file(WORDS)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    rows = QUERIES["op6_packing"](spark, sf).collect()
    padding = check_pieces(rows, texts, lambda x: t.encode(x, add_special_tokens=False).ids)
    assert padding < 0.01 * sum(r.length for r in rows)


def test_packing_edge_rows(spark):
    from pyspark.sql import functions as F

    t = Tokenizer.from_file(WORDS)
    texts = [*TEXTS[:10], "a b c d e f g " * 4000]
    rows = packing.pack(frame(spark, texts), WORDS).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, dict(enumerate(texts)), lambda x: t.encode(x, add_special_tokens=False).ids)
    same = packing.pack(frame(spark, ["x", "x", None], [7, 7, None]).coalesce(1), WORDS).collect()
    assert sorted((r.doc_id is None, r.length, r.offset) for r in same) == [(False, 2, 0), (False, 2, 2), (True, 1, 0)]
    assert packing.pack(frame(spark, ["x"]).limit(0), WORDS).count() == 0


def brute_windows(cuts, penalty):
    best = {0: 0.0}
    for j, (b, p) in enumerate(zip(cuts, penalty)):
        best[b] = min(best[i] + packing.WIDTH - (b - i) + p for i in best if b - packing.WIDTH <= i)
    return best


def test_windows_are_of_least_cost():
    rng = np.random.default_rng(5)
    for _ in range(20):
        cuts = np.cumsum(rng.integers(1, 65, 400)).tolist()
        penalty = rng.choice([0, packing.SENTENCE_CUT, packing.HARD_CUT], 400).tolist()
        ends = packing.best_windows(cuts, penalty, False)
        best = brute_windows(cuts, penalty)
        cost, at = 0, 0
        for e in ends:
            cost, at = cost + packing.WIDTH - (e - at) + penalty[cuts.index(e)], e
        assert cost == best[at] == min(c for b, c in best.items() if b >= cuts[-1] - packing.WIDTH and b < cuts[-1])


def test_dedup_has_sql_and_edge_rows(spark):
    from purchase_signals.llm import exact_dedup as X

    assert "op2_exact_dedup" in ORACLES
    rows = [(5, "a  b"), (3, "a\tb"), (3, "a\tb"), (None, None), (9, ""), (8, "c"), (None, "d"), (None, "d")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, text_sha256 string, run int")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_dedup(df.repartition(5)).collect()), key=str)
    assert got == sorted([(5, 3, 3, False), (3, 3, 3, True), (3, 3, 3, False), (None, 9, 2, False), (9, 9, 2, True), (8, 8, 1, True),
                          (None, None, 2, True), (None, None, 2, False)], key=str)
    assert X.exact_dedup(df.limit(0)).count() == 0
    assert sorted((r.doc_id, r.run) for r in X.deduplicated(df).where("doc_id IS NOT NULL").distinct().collect()) == [(3, 1), (8, 1), (9, 1)]


def test_one_row_of_each_group_stays_with_repeated_and_null_ids(spark):
    from purchase_signals.llm import exact_dedup as X

    rows = [(3, "a\tb"), (3, "a\tb"), (5, "a  b"), (None, "d"), (None, "d"), (None, "d"), (7, "e"), (7, "f"), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, __sha int")
    out = X.deduplicated(df.repartition(4))
    got = sorted(((r.doc_id, " ".join((r.text or "").split())) for r in out.collect()), key=str)
    assert got == sorted([(3, "a b"), (None, "d"), (7, "e"), (7, "f"), (None, "")], key=str)
    assert out.columns == df.columns and X.deduplicated(df.limit(0)).count() == 0


def test_tree_merge_over_many_runs(spark):
    from purchase_signals.llm import exact_dedup as X

    df = spark.range(3000).selectExpr("id AS doc_id", "concat('t ', cast(id % 700 AS string)) AS text").repartition(100)
    got = X.exact_dedup(df)
    assert got.where("kept").count() == 700
    assert got.where("keep_id <> doc_id % 700 OR group_size <> 4 + cast(doc_id % 700 < 200 AS int)").count() == 0


def test_plain_words_have_the_tokenizers_ids():
    import json

    words = packing.word_ids(WORDS)
    model = json.load(open(WORDS))["model"]
    for token, i in model["vocab"].items():
        if token.endswith("</w>"):
            assert [t.id for t in words.tokenizer.model.tokenize(token.removesuffix("</w>"))] == [i]
    sf = "/root/testdata/sf0.01"
    seen = {w for (t,) in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall() for w in (t or "").split()}
    for w in seen:
        plain = packing.PLAIN.fullmatch(w)
        if plain:
            assert words.plain.encode([plain[1].lower()])[0] + words.mark(plain[2]) == words.encode(w), w
