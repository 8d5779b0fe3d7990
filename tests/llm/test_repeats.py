import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from purchase_signals.llm import repeats as R


def brute(texts):
    """By doc: n_bytes, n_removed, n_spans, kept_sha256, from a table of all 400-byte strings."""
    seen = {}
    data = {i: (t or "").encode() for i, t in texts.items()}
    for b in data.values():
        for x in range(len(b) - R.LENGTH + 1):
            s = b[x:x + R.LENGTH]
            seen[s] = seen.get(s, 0) + 1
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for x in range(len(b) - R.LENGTH + 1):
            if seen[b[x:x + R.LENGTH]] > 1:
                gone[x:x + R.LENGTH] = b"\1" * R.LENGTH
        runs = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def check(spark, texts):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, p int, bytes string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(df.repartition(4)).collect()}
    want = brute(texts)
    assert {i: v for i, v in got.items() if v != want[i]} == {} and len(got) == len(want)
    return want


def test_planted_repeats_equal_brute_force(spark):
    rng = random.Random(3)
    letters = "abcdefghij é\n"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, long_passage = make(700), make(3000)
    texts = {0: None, 1: "", 2: "short", 3: "short", 4: make(399), 5: passage[:400], 6: make(50) + passage + make(60)}
    for i in range(7, 19):  # overlapping parts of one passage at every cut
        a = rng.randrange(0, 300)
        texts[i] = make(rng.randrange(0, 90)) + passage[a:a + rng.randrange(390, 460)] + make(rng.randrange(0, 90))
    texts[20] = "a" * 1000
    texts[21] = "ab" * 260 + make(20) + "ab" * 205
    texts[22] = texts[23] = make(900)
    texts[24] = make(100) + long_passage + make(30)
    for i in range(25, 33):  # near copies with an edit somewhere
        k = rng.randrange(0, 3000)
        texts[i] = long_passage[:k] + "#%" + long_passage[k + rng.randrange(0, 3):]
    texts[33] = make(200) + passage + make(10) + passage + make(5)
    want = check(spark, texts)
    assert sum(v[1] > 0 for v in want.values()) > 15


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    df = spark.createDataFrame([(None, "x" * 900)][:n], "doc_id long, text string")
    got = R.remove_repeats(df).collect()
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in got] == [(None, 900, 900, 1)][:n]


def test_long_text_over_slices(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef ") for _ in range(6000))
    batch = __import__("pyarrow").RecordBatch.from_arrays([["s"], [(text + text[1000:2500]).encode()]], names=["a", "b"])
    want = set()
    for data, row, place in R.slices(batch):
        want |= set(zip(place.tolist(), data.tolist()))
    monkeypatch.setattr(R, "SLICE", 1500)
    got = set()
    for data, row, place in R.slices(batch):
        assert len(data) <= 1500
        got |= set(zip(place.tolist(), data.tolist()))
    assert got == want and len(got) == 7500


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    check(spark, dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' WHERE length(text) < 20000").fetchall()))


def test_common_keys_equal_brute_force(spark, monkeypatch):
    """With copies, a passage and a line in most texts, and any share of the keys common."""
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    passage, line, copied = make(620), make(90) + "\n", make(1200)
    texts = {i: make(rng.randrange(80)) + passage + make(rng.randrange(80)) for i in range(30)}
    texts |= {i: copied for i in range(30, 45)} | {45: copied[300:900], 46: copied[:399], 47: copied[:399], 48: make(700)}
    texts |= {i: make(rng.randrange(80)) + line * rng.randrange(5, 9) for i in range(50, 60)}
    for hot in (1, 8, 1 << 30):
        monkeypatch.setattr(R, "HOT", hot)
        want = check(spark, texts)
        assert want[30][1] == want[30][0] and want[45][1] == 600 and want[46][1] == want[48][1] == 0


def test_rows_of_a_common_key_stay_in_their_tasks(spark):
    rows = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 10 < 9, -1).otherwise(F.col("id")).alias("gram"), "id")
    keys = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("gram < 10000")
    kept = R.with_keys(rows, keys, "gram", "n")
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 18000 + 1000 and max(sizes) < 4000
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in rows.where("gram < 10000").collect())


def test_contract_counts_bytes_not_words(spark):
    """Repeated passages of over 50 words but under 400 bytes stay, those from 400 bytes on go, other texts lose nothing."""
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))
    short, long = words(60), words(85)
    assert len(short) == 299 and len(long) == 424
    texts = {0: "X " + short + " x", 1: "Y " + short + " y", 2: "Z " + long + " z", 3: "W " + long + " w", 4: words(100)}
    want = check(spark, texts)
    assert [want[i][1] for i in range(5)] == [0, 0, 426, 426, 0]
