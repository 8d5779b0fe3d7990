import re

import public_tokenizers as P
from test_jaccard import brute as near
from test_tokens import check_pieces
from tokenizers import Tokenizer

import corpus_pipeline
from purchase_signals.llm import pii
from purchase_signals.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900001, None, "en", "s", 0), (900002, "12 34", None, "s", 5)], docs.schema)
    docs = docs.unionByName(extra)
    at = {r.doc_id: r for r in docs.collect()}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        out = stage(fn(spark, docs, SF), "test")
        assert out.columns == docs.columns
        got = {r.doc_id: r for r in out.collect()}
        if name == "language_id":
            assert set(at) - set(got) == {900001, 900002}
        elif name == "exact_dedup":
            keep = {}
            for i in sorted(at):
                keep.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", at[i].text), i)
            assert set(got) == set(keep.values())
        elif name == "ngram_jaccard":
            groups = near({i: r.text for i, r in at.items()})
            assert set(got) == {c for _, c in groups.values()}
        else:
            assert set(got) == set(at)
            assert not any(pii.base_spans(r.text) for r in got.values())
            assert all(r.n_chars == len(r.text) for r in got.values())
        docs, at = out, got
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    check_pieces(pieces, {i: r.text for i, r in at.items()}, lambda x: t.encode(x, add_special_tokens=False).ids)


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id"} <= set(out.columns) and out.count() > 0


def test_documents_stay_where_no_language_was_learned(spark):
    rows = [(1, "the cat", None), (2, "12 .. 3", None), (3, None, None), (4, "", None), (None, "日本語", "ja")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.language_id(spark, df, SF)
    assert sorted((str(r.doc_id), r.lang) for r in out.collect()) == [("1", None), ("None", "ja")]
    assert out.columns == df.columns


def test_stages_on_clashing_names_repeated_rows_and_nulls(spark):
    """Extra columns named like a stage's own come through as they were."""
    t = "the cat sat on the mat with a dog and the bird"
    rows = [(1, t), (1, t), (2, t + " again"), (None, t), (None, None), (3, ""), (4, "a letter"), (4, None)]
    names = ["lang_pred", "__row_tag", "text_sha256", "set_id", "tag", "spans", "score", "_metadata_"]
    base = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = base.selectExpr("*", *[f"concat('{n}', coalesce(doc_id, -1)) AS `{n}`" for n in names])
    kept = {"language_id": 5, "exact_dedup": 4, "ngram_jaccard": 5, "pii": 8}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        for given in (docs, stage(docs, "test")):
            out = fn(spark, given, SF)
            assert out.columns == docs.columns and fn(spark, given.where("false"), SF).count() == 0
            got = out.collect()
            assert all(r[n] == f"{n}{-1 if r.doc_id is None else r.doc_id}" for r in got for n in names)
            assert len(got) == kept[name], name
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, SF).collect()} == {1, 2, 3, 4, None}
