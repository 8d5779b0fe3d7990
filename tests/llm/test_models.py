import zlib

import duckdb
import numpy as np
import pytest

from purchase_signals.llm import langid, toxicity
from purchase_signals.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_accuracy_on_held_out_rows(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(lang) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.98 * len(test)


def test_language_edge_rows(spark):
    rows = [(i, t, lang, "p") for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, None, "en", "p"), (101, "", None, "p"), (102, "12 .. 3", None, "p"), (103, "the dog", None, "p"), (None, "und der hund", None, "p"),
             (103, "the dog", None, "p"), (104, "die katze " * 30000, None, "p"), (105, "日本語", None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    profiles = langid.fit(df)
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(df, profiles).collect() if r.doc_id is None or r.doc_id >= 100}
    assert {(100, "und"), (101, "und"), (102, "und"), (103, "en"), (None, "de"), (104, "de")} <= got
    none = langid.fit(df.limit(0))
    assert none.languages == () and {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), profiles).count() == 0


def test_bundle_is_the_sum_of_bound_vectors():
    h = langid.Letters()
    text = "Ab, c"
    code = [0, *(h.code[ord(c)] for c in "ab"), 0, h.code[ord("c")], 0]
    want = sum(np.roll(h.vectors[a], 2) * np.roll(h.vectors[b], 1) * h.vectors[c] for a, b, c in zip(code, code[1:], code[2:]))
    assert np.array_equal(h.bundle(text), want) and np.array_equal(h.bundle(text), want)
    grams, counts = h.ngrams("aaaa")
    assert counts.sum() == 4


def test_toxicity_on_held_out_rows(spark):
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    n = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == n and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in label]
    y = np.array([label[r.doc_id] for r in test])
    assert toxicity.auc(np.array([r.score for r in test]), y) > 0.7
    assert np.mean([r.predicted for r in test if not label[r.doc_id]]) < 0.03


def test_toxicity_edge_rows(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    docs = [(i, " ".join(["scoundrel" if i % 3 == 0 and k % 6 == 0 else word() for k in range(90)]), "s", 1) for i in range(300)]
    docs += [(1000, None, "s", 1), (1001, "", "s", 1), (1002, "scoundrel " + "x" * 100000, "s", 1), (None, "scoundrel", "s", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, y int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert len(got) == 304 and got[1000].score == got[1001].score and got[1000].n_windows == 0
    right = sum(got[i].predicted == (i % 3 == 0) for i in range(300))
    assert right >= 285
    blank = toxicity.fit(df, labels.limit(0))
    assert {r.score for r in toxicity.score(df, blank).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_windows_cover_the_text():
    for t in ["", "a", "one two three " * 50, "x" * 5000, " lead", "Ünïcode wörds " * 9]:
        assert b"".join(toxicity.windows(t)) == t.lower().encode()


@pytest.mark.parametrize("name", ["op1_toxicity", "op9_language_id"])
def test_scores_do_not_read_ids_or_labels(spark, name):
    import inspect

    fn = {"op1_toxicity": toxicity.score, "op9_language_id": langid.predict}[name]
    assert "label" not in inspect.signature(fn).parameters
