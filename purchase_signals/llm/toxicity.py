"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic
text.  A text is cut into windows of whole words; a window's gain is the number
of bytes it saves when the toxic dictionary's content is added to the ordinary
one.  Adding keeps background words equally cheap on both sides, so a gain
means material that toxic texts share and ordinary texts lack.  The toxic
dictionary is retrained once for each of ``TAILS`` on the windows of toxic texts
whose gain exceeds that quantile of held-back ordinary windows.

Thresholds are calibrated: the shares of a text's windows whose gain reaches
1 to 4 bytes, and the mean gain, go into a logistic regression fitted on
training documents that no dictionary has seen; the best round is kept.

The fit reads a bounded sample: at most ``MAX_DOCS`` documents of either label
and ``MAX_WINDOWS`` evenly spread windows of each (both are parameters).
Scoring reads every window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, prepare

WINDOW = 24
MAX_DOCS, MAX_WINDOWS = 2000, 250
ORDINARY_BYTES, TOXIC_BYTES = 112_640, 5_120
TAILS = (0.9, 0.95, 0.9, 0.98, 0.9)
#: A trained dictionary's entropy tables are shorter than this; behind them is plain content.
TABLES = 512


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30)))


def windows(text: str | None) -> list[bytes]:
    """The whole text, lower-cased, as runs of whole words of at least ``WINDOW`` bytes."""
    data, out, at = (text or "").lower().encode(), [], 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW) + 1 or len(data)
        # a run without blanks is cut so that no window outgrows the compressor's small-input mode
        end = min(end, at + 40 * WINDOW)
        out.append(data[at:end])
        at = end
    return out


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=15, chain_log=15, search_log=4, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(dictionary))


def dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """A trained dictionary; too few samples to train on serve as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d, level=3).as_bytes()
    except zstandard.ZstdError:
        return bytes(TABLES) + b"".join(samples)[-size:]


def with_toxic(ordinary: bytes, toxic: bytes) -> bytes:
    """The ordinary dictionary with the toxic one's content in front of its own."""
    return ordinary[:TABLES] + toxic[TABLES:] + ordinary[TABLES:]


def lengths(c: zstandard.ZstdCompressor, ws: list[bytes]) -> np.ndarray:
    return np.fromiter((len(c.compress(w)) for w in ws), np.int32, len(ws))


def features(gains: np.ndarray) -> list[float]:
    n = max(1, len(gains))
    return [1.0, float(gains.sum()) / n, *(float((gains >= k).sum()) / n for k in (1, 2, 3, 4)),
            min(4.0, float((gains >= 2).sum()))]


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    p = labels.sum()
    return (rank[labels == 1].mean() - (p - 1) / 2) / max(1, len(labels) - p)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps; both labels weigh as the prior of the sample drawn."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(samples: list[tuple[int, list[bytes]]], prior: float) -> Model:
    """Fit on (label, windows) of training documents.  ``prior``: the share of
    toxic labels among all training rows, to which the intercept is set."""
    rng = np.random.default_rng(7)
    by = {label: [ws for y, ws in samples if y == label and ws] for label in (0, 1)}
    if min(len(by[0]), len(by[1])) < 2:
        return Model(b"", b"", ())
    part = {label: (docs[: len(docs) * 6 // 10 + 1], docs[len(docs) * 6 // 10 + 1:] or docs[:1]) for label, docs in by.items()}
    flat = {label: [w for ws in part[label][0] for w in ws] for label in (0, 1)}
    for ws in flat.values():
        rng.shuffle(ws)
    back = flat[0][: max(1, len(flat[0]) // 5)]
    ordinary = dictionary(flat[0][len(back):], ORDINARY_BYTES, 64, 8)
    c0 = compressor(ordinary)
    rest = [(label, ws, lengths(c0, ws)) for label in (0, 1) for ws in part[label][1]]
    y = np.array([r[0] for r in rest], float)
    cost_back, cost_toxic = lengths(c0, back), lengths(c0, flat[1])
    c1, best = compressor(dictionary(flat[1], ORDINARY_BYTES, 64, 8)), None
    for tail in TAILS:
        limit = max(1, np.quantile(cost_back - lengths(c1, back), tail))
        chosen = [w for w, g in zip(flat[1], cost_toxic - lengths(c1, flat[1]), strict=True) if g >= limit]
        toxic = dictionary(chosen or flat[1], TOXIC_BYTES, 16, 6)
        c1 = compressor(with_toxic(ordinary, toxic))
        x = np.array([features(cost - lengths(c1, ws)) for _, ws, cost in rest])
        w = logistic(x, y)
        quality = auc(x @ w, y)
        if best is None or quality > best[0]:
            best = (quality, toxic, w)
    _, toxic, w = best
    drawn = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w = w.copy()
    w[0] += np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)) - np.log(drawn / (1 - drawn))
    return Model(ordinary, with_toxic(ordinary, toxic), tuple(w.tolist()))


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text divides by 5; rows without an id are never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_docs: int = MAX_DOCS, max_windows: int = MAX_WINDOWS) -> Model:
    """Train on rows that are not held out and have a label.  A document
    labelled more than once is toxic if any label says so; null labels do not
    count.  Without documents of both labels the model is empty and scores 0."""
    prepare(docs.sparkSession)
    docs = columns(docs, id_col, text_col)
    known = (labels.where(labels[label_col].isin(0, 1)).groupBy(labels[id_col].alias("doc_id"))
             .agg(F.max(label_col).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & ~held_out())
             .join(docs.select("doc_id"), "doc_id", "left_semi"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs) for y in (0, 1)]
    sample = drawn[0].union(drawn[1])  # at most 2 * max_docs rows, hence the broadcast

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(1):
                ws = windows(text.as_py())
                out.append(ws if len(ws) <= max_windows else [ws[i * len(ws) // max_windows] for i in range(max_windows)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.list_(pa.binary()))], names=["doc_id", "y", "windows"])

    rows = (docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")
            .mapInArrow(cut, "doc_id long, y int, windows array<binary>").collect())
    rows.sort(key=lambda r: (r.doc_id, len(r.windows), r.windows))
    return train([(r.y, [bytes(w) for w in r.windows]) for r in rows], counts.get(1, 0) / max(1, sum(counts.values())))


_PAIRS: dict[tuple[int, int], tuple] = {}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on), n_windows of every row.

    Null and empty texts have no windows and get the score of no gain.  Rows
    with equal texts get equal scores; ids and other columns play no part.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.weights:
            key = (hash(model.ordinary), hash(model.toxic))
            c0, c1 = _PAIRS.setdefault(key, (compressor(model.ordinary), compressor(model.toxic)))
        for b in batches:
            out, n = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            if model.weights:
                x = []
                for i, text in enumerate(b.column(1)):
                    ws = windows(text.as_py())
                    n[i] = len(ws)
                    x.append(features(lengths(c0, ws) - lengths(c1, ws)))
                out = model.score(np.array(x)) if x else out
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out), pa.array((out >= 0.5).astype(np.int32)), pa.array(n)],
                names=["doc_id", "score", "predicted", "n_windows"])

    return columns(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int, n_windows long")
