import gzip
import hashlib
import os
import tempfile

import duckdb
import pytest

from purchase_signals.llm import warc
from purchase_signals.llm.queries import QUERIES


def expected(rows):
    """(page_id, bytes, sha1, type, refers_to) by plain grouping; of rows that tie one responds."""
    best = {}
    for p, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 1000:
            k = (p is not None, p or 0)
            best[b] = max(best.get(b, k), k)
    out, done = [], set()
    for p, _, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (html or "").encode()
        lead = len(b) < 1000 or ((p is not None, p or 0) == best[b] and b not in done)
        if lead and len(b) >= 1000:
            done.add(b)
        top = best.get(b)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if lead else "revisit", None if lead else (top[1] if top[0] else None)))
    return sorted(out, key=repr)


COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def found(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_plain_grouping(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{path}/pages.parquet'").fetchall()
    assert found(QUERIES["op11_warc"](spark, path)) == expected(rows)


LONG = "<p>é</p>" * 200
ROWS = [*[(i, f"http://www.Example.com/{i % 7}?q={i}", LONG) for i in range(40)], (50, "http://a.org", "x" * 999), (51, "http://a.org", "x" * 999),
        (52, "http://a.org/", "x" * 1000), (53, None, "x" * 1000), (None, "http://n.org", "x" * 1000), (None, None, None), (54, "", ""),
        (54, "", ""), (60, "http://same/", "y" * 2000), (60, "http://same/", "y" * 2000), (60, "http://same/", "y" * 2000),
        (61, "not a url\r\nWARC-Type: x", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (62, "http://h:80/b c\t", "z\x00\r\n" * 70000),
        (None, "http://n", "w" * 1500), (None, "http://n", "w" * 1500)]


def frame(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, 1, "a", 2) for r in rows], "page_id long, url string, html string, key int, archive string, sha int")
    return df.repartition(parts)


@pytest.mark.parametrize("hot,block,size", [(1024, 2000, 1 << 28), (2, 3, 500), (10**6, 1, 1)])
def test_edge_rows_and_hot_payloads(spark, monkeypatch, hot, block, size):
    """Ties, nulls, repeated rows, long texts, header-like payloads, clashing names;
    a payload of most rows spread by page id, small blocks, many archives."""
    monkeypatch.setattr(warc, "HOT", hot)
    df = frame(spark, ROWS)
    index = warc.archive(df, warc.new_folder(spark), archive_bytes=size, block_captures=block)
    records = warc.pages_records(df, index, payloads=True).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in records), key=repr) == expected(ROWS)
    by_page = {r[0]: (r[2] or "").encode() for r in ROWS if r[0] is not None}
    assert all(bytes(r.payload) == by_page[r.page_id] for r in records if r.payload is not None and r.page_id is not None)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in records)


def test_captures_of_a_url(spark):
    df = frame(spark, ROWS)
    index = warc.archive(df, warc.new_folder(spark))
    asked = spark.createDataFrame([("http://www.example.com/3?q=3",), ("https://same/",), ("https://same/",), ("http://nowhere/",), (None,)], "url string")
    got = sorted(((r.url, r.page_id) for r in warc.url_records(asked, index).collect()), key=repr)
    want = [("http://www.Example.com/3?q=3", 3), *[("http://same/", 60)] * 3, ("about:blank", None), ("about:blank", 53), *[("about:blank", 54)] * 2]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    df = frame(spark, ROWS).where("false")
    index = warc.archive(df, warc.new_folder(spark))
    assert index.parts == [] and found(warc.pages_records(df, index)) == []


def test_archive_files_hold_whole_records(spark):
    """A whole archive decompresses to WARC records one after another."""
    folder = tempfile.mkdtemp(prefix="warc-")
    index = warc.archive(frame(spark, ROWS), folder)
    count = 0
    for name in os.listdir(f"{folder}/archives"):
        data = gzip.open(f"{folder}/archives/{name}").read()
        at = 0
        while at < len(data):
            head, _, rest = data[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            n = int(head.rsplit(b"Content-Length: ", 1)[1])
            assert rest[n:n + 4] == b"\r\n\r\n"
            at += len(head) + 4 + n + 4
            count += b"warcinfo" not in head.split(b"\r\n")[1]
    assert count == len(ROWS) and sum(len(p) for p in index.parts) > 0


def test_blocks_are_read_by_binary_search(spark):
    """A look-up reads its own block, not those before it."""
    index = warc.archive(frame(spark, ROWS), warc.new_folder(spark), block_captures=2)
    reader = warc.Reader(index)
    assert len(list(reader.find(warc.order(warc.url_key("http://www.example.com/6?q=6"), 6)))) == 1
    assert reader.reads <= 2


@pytest.mark.parametrize("url,key", [("http://www.Example.com/a?b#c", "com,example,www)/a?b"), ("https://u@h.org:8080", "org,h:8080)/"),
                                     ("http://10.0.0.1/x", "10.0.0.1)/x"), ("ftp://[::1]/", "[::1])/"), ("no url", "no%20url"), (None, "")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key
