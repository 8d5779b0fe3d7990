"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed by its code.
An n-gram of three letters is bound into one vector: each letter's vector is
permuted (rotated) by its place in the n-gram and the three are multiplied
component by component.  A text's vector bundles (adds) its n-gram vectors; a
language's prototype bundles the unit vectors of training texts; a text gets
the language whose prototype has the greatest cosine with it.

Words are framed by a blank and everything that is no letter counts as one
blank.  Prototypes are summed in the tasks, language by language and component
by component; the driver receives ``DIMS`` numbers for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import columns, lean, prepare
from .toxicity import held_out

DIMS = 512
#: Letters are told apart by code point modulo this; slot 0 is the blank.
LETTERS = 4096
SEED = 20240607
#: Bound on the training rows read for the prototypes.
MAX_TRAIN = 100_000
CACHE_NGRAMS = 24_000


class Letters:
    """Letter codes and the vectors of n-grams, made when first met."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.vectors = (rng.integers(0, 2, (LETTERS, DIMS), np.int8) * 2 - 1).astype(np.int8)
        points = np.arange(0x110000)
        letter = np.fromiter((chr(i).isalpha() for i in points), bool, len(points))
        self.code = np.where(letter, points % (LETTERS - 1) + 1, 0).astype(np.int16)
        self.known: np.ndarray = np.empty(0, np.int64)
        self.rows = np.empty((0, DIMS), np.int8)

    def ngrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-gram codes of the whole text and their counts; none without letters."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
        code = np.concatenate([[0], self.code[points], [0]]).astype(np.int64)
        code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]  # one blank for each run
        if not code.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.unique((code[:-2] * LETTERS + code[1:-1]) * LETTERS + code[2:], return_counts=True)

    def bind(self, grams: np.ndarray) -> np.ndarray:
        v = self.vectors
        first, second, third = v[grams // (LETTERS * LETTERS)], v[grams // LETTERS % LETTERS], v[grams % LETTERS]
        return np.roll(first, 2, axis=1) * np.roll(second, 1, axis=1) * third

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The text's vector, or None if it has no letter."""
        grams, counts = self.ngrams(text)
        if not len(grams):
            return None
        total = np.zeros(DIMS, np.float64)
        for i in range(0, len(grams), 8192):
            g, c = grams[i:i + 8192], counts[i:i + 8192].astype(np.float32)
            at = np.searchsorted(self.known, g)
            at[at == len(self.known)] = 0
            hit = self.known[at] == g if len(self.known) else np.zeros(len(g), bool)
            total += c[hit] @ self.rows[at[hit]].astype(np.float32)
            if not hit.all():
                fresh = self.bind(g[~hit])
                total += c[~hit] @ fresh.astype(np.float32)
                if len(self.known) < CACHE_NGRAMS:
                    keys = np.concatenate([self.known, g[~hit]])
                    order = np.argsort(keys)
                    self.known, self.rows = keys[order], np.concatenate([self.rows, fresh])[order]
        return total


_LETTERS: list[Letters] = []


def letters() -> Letters:
    if not _LETTERS:
        _LETTERS.append(Letters())
    return _LETTERS[0]


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # a unit row for each language


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN) -> Profiles:
    """Prototypes from rows with a language, not held out; of more than
    ``max_train`` such rows, a share chosen by a hash of the id.  Rows without
    id, text or letters add nothing; without rows there are no languages."""
    prepare(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    total = rows.select("doc_id").count()
    if total > max_train:
        parts = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < int(parts * max_train / total))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, by = letters(), {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v = h.bundle(text.as_py())
                if v is not None:
                    by[lang] = by.get(lang, 0) + v / max(float(np.linalg.norm(v)), 1e-12)
        for lang in sorted(by):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMS), pa.array(np.arange(DIMS, dtype=np.int32)), pa.array(by[lang])], names=["lang", "i", "v"])

    got = rows.select("lang", "text").mapInArrow(lean(sums), "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")).collect()
    names = sorted({r.lang for r in got})
    out = np.zeros((len(names), DIMS))
    for r in got:
        out[names.index(r.lang), r.i] = r.v
    return Profiles(tuple(names), out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12))


def scores(texts: pa.Array, profiles: Profiles) -> tuple[pa.Array, pa.Array]:
    h, names, best = letters(), [], []
    for text in texts:
        v = h.bundle(text.as_py()) if profiles.languages else None
        if v is None:
            names.append("und")
            best.append(0.0)
            continue
        cosine = profiles.prototypes @ v / max(float(np.linalg.norm(v)), 1e-12)
        k = int(np.argmax(cosine))
        names.append(profiles.languages[k])
        best.append(min(1.0, max(0.0, float(cosine[k]))))
    return pa.array(names, pa.string()), pa.array(best, pa.float64())


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows one to one as doc_id, lang_pred, score.

    ``und`` with score 0 where the text is null, empty or has no letter, or
    where no language was learned; else the score is the cosine with the best
    prototype, cut to 0 to 1.  Ties go to the first language by name.  Repeated
    rows are predicted alike; other columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *scores(b.column(1), profiles)], names=["doc_id", "lang_pred", "score"])

    return columns(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, lang_pred string, score double")


def annotate(docs: DataFrame, profiles: Profiles, text_col: str = "text", pred_col: str = "lang_pred") -> DataFrame:
    """``docs`` with all its columns and one more, ``pred_col`` (a name it has not
    yet), the predicted language: null without a letter, ``und`` where no language
    was learned."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = scores(b.column(at), profiles)[0]
            lettered = pa.array([any(map(str.isalpha, (t.as_py() or "").lower())) for t in b.column(at)], pa.bool_())
            yield b.append_column(pred_col, pc.if_else(lettered, names, pa.scalar(None, pa.string())))

    schema = StructType([*docs.schema.fields, StructField(pred_col, StringType())])
    return docs.mapInArrow(lean(run), schema)
