"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are split before encoding, so that no call sees more than about
``PART`` characters.  A text is only split before a blank that follows a
character which is no white space: the splitting pattern has no match that
contains such a place, so both sides split into the same matches as the whole.
Decoding works on raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import columns, prepare

PART = 100_000
SAFE = re.compile(r"[^\s](?= )")
_CODECS: dict[tuple[str, str], "Codec"] = {}


class Codec:
    """tiktoken's encoder for a rank file and the decimal text of every id."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.decimal = [b"%d" % i for i in range(max(table.values()) + 1)]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PART:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for part in parts(text):
            ids += self.encoding.encode_ordinary(part)
        return ids


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` in order, cut at the first safe place after every ``size`` characters."""
    at = 0
    while at < len(text):
        cut = SAFE.search(text, at + size)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def codec(ranks: str, pattern: str) -> Codec:
    if (ranks, pattern) not in _CODECS:
        _CODECS[ranks, pattern] = Codec(ranks, pattern)
    return _CODECS[ranks, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every text; null counts as empty, whose
    array is empty.  Rows are kept one to one, whatever their ids."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for b in batches:
            ids = [c.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return columns(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, bytes: the tokens' bytes concatenated; null or empty arrays give no bytes."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for b in batches:
            out = [c.encoding.decode_bytes(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return rows.select(rows[id_col].alias("doc_id"), rows[ids_col].alias("ids")).mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text: ids
    encoded, decoded again and digested in one pass.  Null counts as empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for b in batches:
            n, ids_sha, out_sha = [], [], []
            for text in b.column(1):
                ids = c.encode(text.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(map(c.decimal.__getitem__, ids))).hexdigest())
                out_sha.append(hashlib.sha256(c.encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(out_sha)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return columns(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
