"""Suffix-array dedup: bytes covered by a repeated 400-byte string.

Not the doubling of position ranks, but minimizers and hash classes at growing
lengths in its place: no ranks are carried and no pairs sorted.  Of every ``LENGTH``-byte
string the position of its smallest ``GRAM``-byte substring (by a hash; the
leftmost of equals) is its anchor.  The anchor depends on the string alone, so
equal strings have anchors at equal distance, and one position in about 140 is
an anchor at all.  An anchor p stands for the strings that start at p - d, d in
a range.

Each round names blocks by the MD5 of all their bytes, cut from the text anew;
Spark groups equal names, and positions alone in their class leave.  The first
round groups by the gram.  In the next rounds the range of d is cut into aligned blocks of ``BLOCKS`` starts;
a block's core, the bytes all of its strings share, grows from 128 bytes to 337,
393 and at last the whole 400.  A block whose core is unique holds no repeat.  A
block all of whose bytes (core and both margins) occur twice is repeated as a
whole.  Of the rest, one position for each distinct block goes on to the next
round, so a passage in a third of all documents goes on once and not once for
each copy.

Copies of a whole text are one text to these rounds, found by its SHA-256; each
is repeated throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare, stage

LENGTH, GRAM = 400, 128
#: Starts in a block, round by round.
BLOCKS = (64, 8, 1)
#: Bytes hashed at a time; positions must fit the low bits of a packed hash.
POSITION_BITS = 20
SLICE = (1 << POSITION_BITS) - 1
BASE = 0x9E3779B97F4A7C15
#: A key on more than 1/HOT of the rows to be joined is broadcast; there are fewer than HOT.
HOT = 1024


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        m = min(done, n - done)
        out[done:done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    return out


class Hasher:
    """Rolling polynomial hashes of all ``GRAM``-byte substrings of a buffer."""

    def __init__(self):
        self.up = _powers(BASE, SLICE + 1)
        self.down = _powers(pow(BASE, -1, 1 << 64), SLICE + 1)
        self.byte = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)

    def grams(self, data: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[:len(data)], out=total[1:])
        h = (total[GRAM:] - total[:-GRAM]) * self.down[:len(data) - GRAM + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    n, span = len(a) - width + 1, 1
    while span * 2 <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[:n], a[width - span:width - span + n])


def anchors(data: np.ndarray, start_ok: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """(position, smallest d, greatest d, gram hash) of the anchors of a buffer
    of at most ``SLICE`` bytes.  ``start_ok``: a string may start here."""
    h = hasher.grams(data)
    low = np.uint64(SLICE)
    packed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_min(packed, LENGTH - GRAM + 1) & low).astype(np.int64)
    change = np.concatenate([[True], (at[1:] != at[:-1]) | ~start_ok[:-1] | ~start_ok[1:]])
    first = np.flatnonzero(change)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    keep = start_ok[first]
    first, last = first[keep], last[keep]
    p = at[first]
    return p, p - last, p - first, h[p].view(np.int64)


def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row of each byte, position of each byte in its text) of buffers of
    at most ``SLICE`` bytes: short texts together, long ones in overlapping parts."""
    parts, rows, places, size = [], [], [], 0
    for i, value in enumerate(batch.column(1)):
        text = np.frombuffer(value.as_buffer(), np.uint8)
        for at in range(0, max(1, len(text) - LENGTH + 1), SLICE - LENGTH + 1):
            part = text[at:at + SLICE]
            if len(part) < LENGTH:
                continue
            if size + len(part) > SLICE:
                yield np.concatenate(parts), np.concatenate(rows), np.concatenate(places)
                parts, rows, places, size = [], [], [], 0
            parts.append(part)
            rows.append(np.full(len(part), i, np.int32))
            places.append(np.arange(at, at + len(part)))
            size += len(part)
    if parts:
        yield np.concatenate(parts), np.concatenate(rows), np.concatenate(places)


_HASHER: list[Hasher] = []


def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of texts given as (text_sha256, bytes).  A task takes a text that
    it has met before only once, so that copies thin out before any shuffle."""
    if not _HASHER:
        _HASHER.append(Hasher())
    met: set[str] = set()
    for batch in batches:
        names = batch.column(0).to_pylist()
        fresh = [i for i, name in enumerate(names) if not (name in met or met.add(name))]
        batch = batch.take(pa.array(fresh, pa.int32()))
        for data, row, place in slices(batch):
            end = np.arange(len(data) - LENGTH + 1) + LENGTH - 1
            start_ok = (row[:len(end)] == row[end]) & (place[end] - place[:len(end)] == LENGTH - 1)
            p, d1, d2, h = anchors(data, start_ok, _HASHER[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[p])), pa.array(place[p]), pa.array(d1.astype(np.int32)),
                 pa.array(d2.astype(np.int32)), pa.array(h)], names=["text_sha256", "p", "d1", "d2", "gram"])


def divided(rows: DataFrame, keys: DataFrame, key: str, n: str) -> tuple[DataFrame, DataFrame]:
    """(rows of common keys, other rows).  ``keys`` has one row for each key and
    as ``n`` how many rows have it; both frames are staged, since they are read
    more than once.  Common keys are few and broadcast, so their rows stay in
    the tasks that read them, where a shuffle would bring each key's to one."""
    total = keys.agg(F.sum(n)).first()[0] or 0
    common = F.broadcast(keys.where(F.col(n) * HOT > total).select(key))
    return rows.join(common, key, "left_semi"), rows.join(common, key, "left_anti")


def with_keys(rows: DataFrame, keys: DataFrame, key: str, n: str) -> DataFrame:
    """The rows whose key is among ``keys`` (both as in ``divided``)."""
    common, others = divided(rows, keys, key, n)
    return common.unionByName(others.join(keys.select(key), key, "left_semi"))


def piece(first: Column, length: Column) -> Column:
    """``length`` bytes of the column ``bytes`` from the 0-based position ``first``."""
    return F.substring(F.col("bytes"), (first + 1).cast("int"), length.cast("int"))


def ranked(nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Cut each node's range of d into aligned blocks of ``width`` and rank them:
    ``core`` names the bytes all strings of the block share, ``whole`` all bytes
    any of its strings has."""
    block = nodes.withColumn("block", F.explode(F.sequence(F.floor(F.col("d1") / width), F.floor(F.col("d2") / width))))
    low, high = F.col("block") * width, F.col("block") * width + (width - 1)
    block = block.select("text_sha256", "p", "weight", low.alias("low"), high.alias("high"),
                         F.greatest("d1", low).alias("d1"), F.least("d2", high).alias("d2"))
    core = piece(F.col("p") - F.col("low"), LENGTH - (F.col("high") - F.col("low")))
    whole = piece(F.col("p") - F.col("d2"), LENGTH + F.col("d2") - F.col("d1"))
    name = lambda b, *c: F.unhex(F.md5(F.concat(b, F.concat_ws(":", *c).cast("binary"))))
    return block.join(texts, "text_sha256").select(
        "text_sha256", "p", "weight", F.col("d1").cast("int").alias("d1"), F.col("d2").cast("int").alias("d2"),
        name(core, F.lit("core"), "low").alias("core"), name(whole, F.lit("whole"), "d1", "d2").alias("whole"))


def round_of(nodes: DataFrame, texts: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(spans found repeated, nodes of the next round).

    A class of equal blocks with two or more positions is repeated.  Where other
    blocks have the same core, one position of every class goes on; a class
    already found weighs 2 there, so it can still be met by others.
    """
    rows = stage(ranked(nodes, texts, width), f"ranked-{width}")
    classes = rows.groupBy("core", "whole").agg(
        F.sum("weight").alias("n"), F.min(F.struct("text_sha256", "p", "d1", "d2")).alias("head"))
    classes = stage(classes, f"classes-{width}")
    twice = classes.where("n >= 2")
    spans = with_keys(rows.where("weight = 1"), twice, "whole", "n").select(
        "text_sha256", (F.col("p") - F.col("d2")).alias("start"), (F.col("p") - F.col("d1") + LENGTH).alias("end"))
    open_cores = classes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds >= 2 AND least = 1")
    rest = with_keys(classes, stage(open_cores, f"cores-{width}"), "core", "kinds").select(
        "head.*", F.least("n", F.lit(2)).alias("weight"))
    return spans, rest


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_sha256, bytes, starts, ends) to the counts and digest of what is left."""
    for b in batches:
        removed, n_spans, kept = [], [], []
        for text, starts, ends in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            data, runs, at = memoryview(text.as_buffer()), merged(list(zip(starts, ends, strict=True))), 0
            digest = hashlib.sha256()
            for start, end in runs:
                digest.update(data[at:start])
                at = end
            digest.update(data[at:])
            removed.append(sum(e - s for s, e in runs))
            n_spans.append(len(runs))
            kept.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept)],
            names=["text_sha256", "removed", "spans", "kept"])


def repeated_spans(long_texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text_sha256, start, end) of repeated strings, overlapping each other, and
    the distinct texts (text_sha256, bytes) with any candidate."""
    found = stage(long_texts.mapInArrow(sampled, "text_sha256 string, p long, d1 int, d2 int, gram long"), "anchors")
    place = F.xxhash64("text_sha256", "p")
    twice = found.groupBy("gram").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b")
    twice = stage(twice.select("gram", "n"), "grams")
    nodes = stage(with_keys(found, twice, "gram", "n").select("text_sha256", "p", "d1", "d2").distinct(), "nodes")
    named = nodes.select("text_sha256").distinct()
    # Grouped before the join, so that a task sends one of the copies it has read.
    texts = stage(long_texts.groupBy("text_sha256").agg(F.any_value("bytes").alias("bytes")).join(named, "text_sha256"), "texts")
    nodes, spans = nodes.withColumn("weight", F.lit(1).cast("long")), None
    for width in BLOCKS:
        got, nodes = round_of(nodes, texts, width)
        spans = got if spans is None else spans.union(got)
    return spans, texts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null text counts as empty; texts under 400 bytes and empty texts lose
    nothing.  Rows repeated with the same text, whatever their ids, are copies
    of each other and lose everything from 400 bytes on.  An empty table gives
    an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    data = F.coalesce("text", F.lit("")).cast("binary")
    docs = columns(docs, id_col, text_col).select(
        "doc_id", F.sha2(data, 256).alias("text_sha256"), F.octet_length(data).cast("long").alias("n_bytes"), data.alias("bytes"))
    long_texts = docs.where(F.col("n_bytes") >= LENGTH).select("text_sha256", "bytes")
    spans, texts = repeated_spans(long_texts)
    lists = spans.groupBy("text_sha256").agg(F.collect_set(F.struct("start", "end")).alias("s"))
    cut = stage(texts.join(lists, "text_sha256").select("text_sha256", "bytes", "s.start", "s.end").mapInArrow(
        cut_spans, "text_sha256 string, removed long, spans long, kept string"), "cut")
    rows = stage(docs.select("doc_id", "text_sha256", "n_bytes"), "rows")
    copies = stage(rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "copies")
    common, others = divided(rows, copies, "text_sha256", "n")
    # A text of which there are copies needs no other fact.
    facts = others.join(copies.join(cut, "text_sha256", "full_outer"), "text_sha256", "left").unionByName(
        common.withColumn("n", F.lit(2)), allowMissingColumns=True)
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    return facts.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("kept", "text_sha256")).alias("kept_sha256"))
