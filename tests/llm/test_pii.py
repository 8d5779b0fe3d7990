import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from purchase_signals.llm import pii, tagger
from purchase_signals.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_base(text):
    """The patterns as they are stated, with the checks on every match."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 13 <= len(d) <= 19 and total % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choice("01259@.+-() ab%é") for _ in range(rng.randrange(0, 60)))
        assert pii.base_spans(t) == brute_base(t), t
    for t in ["a@b.c@d.e.f", "x@@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.1.1.1", "4777431686562174", "4777-4316 8656-2174",
              "+1 (808) 555-5385.", "a@b.-", "é@x.com", "%+-@a.b"]:
        assert pii.base_spans(t) == brute_base(t)
    assert pii.base_spans("9" * 50000 + "@" + "a" * 50000) == []


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    t = tagger.Tagger.fresh()
    t.weights = {k: v.astype(np.float64) for k, v in t.weights.items()}
    x, y = rng.integers(0, tagger.CLASSES, (5, 3)), np.array([[0, 1, 3], [1, 2, 4], [2, 0, 0], [0, 5, 7], [3, 6, 8]])
    _, g = tagger.gradients(t, x, y)
    for name, w in t.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            old, eps = w[at], 1e-3
            w[at] = old + eps
            up = tagger.gradients(t, x, y)[0]
            w[at] = old - eps
            down = tagger.gradients(t, x, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3, name


def test_decode_is_the_best_path():
    t = tagger.Tagger.fresh(9)
    x = np.random.default_rng(2).integers(0, tagger.CLASSES, (4, 6))
    e, _ = t.emissions(x)
    move = t.weights["move"] + tagger.allowed()
    got = t.decode(x)
    for k in range(x.shape[1]):
        best = max(itertools.product(range(tagger.TAGS), repeat=4), key=lambda p: move[tagger.TAGS, p[0]] + sum(
            e[i, k, p[i]] for i in range(4)) + sum(move[p[i], p[i + 1]] for i in range(3)))
        assert tuple(got[:, k]) == best


@pytest.fixture(scope="module")
def trained(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 10 <> 3"))


def test_tagger_finds_held_out_spans_and_leaves_clean_text(trained):
    t = trained
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id % 10 = 3").fetchall()]
    found = total = extra = 0
    for text in texts:
        base = pii.base_spans(text)
        if not pii.TRIGGER.search(text):
            continue
        first, views = pii.windows(pii.classes(text))
        tags = np.zeros(len(text), np.int8)
        got = t.decode(views.T)[pii.MARGIN:pii.MARGIN + pii.STEP]
        for k, p in enumerate(first.tolist()):
            middle = tags[p:p + pii.STEP]
            middle[:] = got[:len(middle), k]
        alone = set(pii.tag_spans(tags))
        found += sum(s in alone for s in base)
        total += len(base)
        extra += len(pii.added_spans(text, tags, base))
    assert found >= 0.7 * total > 0  # numbers that fail the card's check digit look the same to it
    assert extra < 0.1 * total


def test_altered_spans_of_held_out_documents(trained):
    """Spans in forms that the patterns miss, in documents the tagger has not seen:
    recall and precision of the added spans, by place and kind."""
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id % 10 = 3 AND text IS NOT NULL").fetchall()]
    hit, wanted, added = {k: 0 for k in pii.KINDS}, {k: 0 for k in pii.KINDS}, 0
    for text in texts:
        if not pii.base_spans(text):
            continue
        copy, spans = pii.altered_copy(text, seed=1)
        base = pii.base_spans(copy)
        wanted_here = {s for s in spans if all(s[2] <= b[1] or b[2] <= s[1] for b in base)}
        got = {s[:3] for s in pii.find([copy], trained)[0] if not s[3]}
        added += len(got)
        for kind in pii.KINDS:
            wanted[kind] += sum(s[0] == kind for s in wanted_here)
            hit[kind] += sum(s[0] == kind for s in wanted_here & got)
    recall, precision = sum(hit.values()) / sum(wanted.values()), sum(hit.values()) / max(1, added)
    print("altered spans:", hit, wanted, f"recall {recall:.3f} precision {precision:.3f}")
    assert recall >= 0.8 and precision >= 0.9
    assert all(hit[k] >= 0.6 * wanted[k] for k in pii.KINDS)


def test_altered_copies_keep_their_places():
    text = "mail a.b@mail7.example.com or 161.17.88.162 or 4777431686562174 or +1 (808) 555-5385 now"
    for seed in range(200):
        copy, spans = pii.altered_copy(text, seed)
        assert [k for k, *_ in spans] == ["email", "ip", "card", "phone"]
        assert copy.startswith("mail a.b") and copy.endswith(" now")
        assert all(pii.plausible(k, copy[s:e].strip()) for k, s, e in spans), copy
    assert pii.altered_copy("no data", 0) == ("no data", [])
    assert not pii.whole("x123456789", 1, 10) and pii.whole("x 123456789.", 2, 11)


def test_windows_meet_without_gaps(trained):
    """A span that lies over a window's edge is found whole wherever it lies."""
    for pad in range(0, 140, 7):
        text = "word " * 60
        text = text[:pad] + " jane.miller@mail6.example.com " + text[pad:]
        spans = pii.find([text], trained)[0]
        assert [s for s in spans if s[3]] == [("email", pad + 1, pad + 30, True)]
        assert all(s[3] for s in spans)


def test_edge_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (None, "a@b.co", "k"), (4, "a@b.co +12 345 678 901", "k"), (4, "a@b.co +12 345 678 901", "k"),
            (5, "x " * 200000 + "10.0.0.1", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.tag(df, None).collect()
    assert sorted((r.doc_id or 0, len(r.spans)) for r in got) == [(0, 1), (1, 0), (2, 0), (4, 2), (4, 2), (5, 1)]
    clean = {(r.doc_id, r.text, r.spans) for r in pii.mask(df.where("doc_id < 5 OR doc_id IS NULL"), None).collect()}
    assert clean == {(1, None, "k"), (2, "", "k"), (None, "<EMAIL>", "k"), (4, "<EMAIL> <PHONE>", "k")}
    assert pii.fit(df.limit(0)) is None and pii.tag(df.limit(0), None).count() == 0


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    for r in QUERIES["op7_pii"](spark, sf).collect():
        base = brute_base(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in PATTERNS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(joined.split(",") if joined else []) <= set(spans)
        key = [(list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert key == sorted(key)
