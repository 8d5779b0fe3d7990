"""Self-join of documents on the Jaccard similarity of their word shingles, by a
token-group matrix, as connected components.

1. Documents with equal shingle sets are one set (found by a 128-bit digest).
2. Tokens (shingle hashes) that only one set has cannot be in any overlap.  Sets
   are dealt out by token in compact batches; what comes back to each set are
   its tokens that others have too.  Sets for which those are under 75 % of
   their own have no partner and leave.
3. Similar sets are partitioned into groups: each set is compared with the most
   central set that has a min-hash in common with it (the one with the greatest
   share of tokens that others have).  Pairs that share half of the smaller set
   put both into one group; pairs over the threshold are links.
4. A set keeps the tokens that a set outside its component of links has too; with
   fewer than 75 % of its own it has no link left to find and leaves.
5. The matrix: the union of each group's tokens, as rows (group, token), in
   parts by token, so that no union is one row.  The overlap of a set with a group's union bounds its overlap with any member; only
   groups that reach the bound are opened, and their members that share a rare
   token with the set are compared with it.
6. A set's own group is opened too: overlaps of its remaining members are products
   of blocks of the token matrix, taken block pair by block pair in tasks, which
   return only links that join components.

Two sets of one component need no comparison, and a group's union stands for all
of its members.  A crowd of near copies is mostly linked in step 3, with work in
proportion to its size; of what is left in one group every two blocks of
``BLOCK`` sets are multiplied.  Nothing is capped: the bounds are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import TAG, TAG_TYPE, columns, lean, prepare, stage, tag_rows

#: Similarity of at least this many percent links two sets.
PERCENT = 75
#: Tokens of a bucket, on average.
BUCKET_TOKENS = 2_000_000
#: Min-hashes by which step 3 finds sets to compare.
KEYS = 8
#: Sets in a block of a group's matrix, and columns multiplied at a time.
BLOCK, COLUMNS = 256, 8192
#: Tokens of a part of a group's union, on average; larger unions are split by token.
UNION = 100_000
#: The place of a token that several sets of a batch have.
MANY = 0xFFFF
#: Bytes of a token.
BYTES = shingles.BITS // 8

DEALT = "route long, kind int, batch long, places binary, tokens binary"
_DEALT = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("batch", pa.int64()), ("places", pa.binary()), ("tokens", pa.binary())])
DIRECTORY, KNOWN, QUESTION = 0, 1, 2


def least_overlap(n):
    """Tokens that a set of ``n`` must share with any partner."""
    return -(-n * PERCENT // 100)


def text_sets(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return shingles.sets([np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(column)])


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, bytes, others) to (doc_id, n_shingles, set_id, others); no set_id for empty sets."""
    for b in batches:
        found = text_sets(b, 1)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(s) for s in found], pa.int64()),
             pa.array([digest(s) if len(s) else None for s in found], pa.binary()), *b.columns[2:]],
            names=["doc_id", "n_shingles", "set_id", *b.schema.names[2:]])


def packed(tokens: np.ndarray) -> bytes:
    """Ascending tokens as their differences, byte plane by byte plane, compressed:
    the upper planes are almost all zero."""
    planes = np.diff(tokens.astype("<u8"), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :BYTES].T
    return squeezed(np.ascontiguousarray(planes))


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def loosened(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    """The tokens of packed arrays."""
    out = []
    for b in blobs:
        planes = np.frombuffer(loosened(b), np.uint8).reshape(BYTES, -1)
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, :BYTES] = planes.T
        out.append(np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64))
    return out


def packed_places(places: np.ndarray) -> bytes:
    return squeezed(np.ascontiguousarray(places.astype("<u2").view(np.uint8).reshape(-1, 2).T))


def unpacked_places(blobs: list[bytes]) -> np.ndarray:
    planes = (np.frombuffer(loosened(b), np.uint8).reshape(2, -1) for b in blobs)
    return np.concatenate([np.empty(0, "<u2"), *(np.ascontiguousarray(p.T).view("<u2").ravel() for p in planes)])


def rows(items: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*items, strict=True), _DEALT, strict=True)], schema=_DEALT)


def deal(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts to rows by token bucket: a directory of the batch's sets, the tokens
    that several of them have (known to be shared), and the question for every
    other token.  A token that several have is asked for once, so a token that
    many documents have costs one entry for each batch."""
    from pyspark import TaskContext

    first, met, width = TaskContext.get().partitionId() << 32, set(), -(-(1 << shingles.BITS) // buckets)
    for number, b in enumerate(batches):
        names, found = [], []
        for s in text_sets(b, 0):
            name = digest(s)
            if len(s) and name not in met:
                met.add(name)
                names.append(name)
                found.append(s)
        if not found:
            continue
        batch = first + number
        sizes = np.array([len(s) for s in found], "<u4")
        tokens, places = np.concatenate(found), np.repeat(np.arange(len(found), dtype="<u2"), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, places = tokens[order], places[order]
        same = tokens[1:] == tokens[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        out = [(batch, DIRECTORY, batch, sizes.tobytes(), b"".join(names))]
        if several.any():
            out.append((batch, KNOWN, batch, packed_places(places[several]), packed(tokens[several])))
        places[several] = MANY
        once = np.concatenate([[True], ~same])
        tokens, places = tokens[once], places[once]
        cuts = np.searchsorted(tokens // np.uint64(width), np.arange(buckets + 1, dtype=np.uint64)).tolist()
        out += [(k, QUESTION, batch, packed_places(places[i:j]), packed(tokens[i:j]))
                for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
        yield rows(out)


def runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """The rows of each value of ``by``, which come one after the other."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and held[-1][by] != row[by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Questions of each bucket to the tokens that are shared, by batch; the
    other rows pass through."""
    def questions() -> Iterator[pa.RecordBatch]:
        nonlocal passed
        for b in batches:
            kind = b.column(1).to_numpy()
            if (kind != QUESTION).any():
                passed += b.filter(pa.array(kind != QUESTION)).to_pylist()
            yield b.filter(pa.array(kind == QUESTION))

    passed: list[dict] = []
    for bucket in runs(questions(), "route"):
        if passed:
            yield rows([tuple(r.values()) for r in passed])
            passed = []
        each = unpacked([r["tokens"] for r in bucket])
        tokens, places = np.concatenate(each), unpacked_places([r["places"] for r in bucket])
        batch = np.repeat(np.arange(len(bucket)), [len(t) for t in each])
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        same = ordered[1:] == ordered[:-1]
        shared = np.empty(len(tokens), bool)
        shared[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        shared &= places != MANY
        ends = np.searchsorted(batch[shared], np.arange(len(bucket) + 1)).tolist()
        kept_places, kept_tokens = places[shared], tokens[shared]
        out = [(r["batch"], KNOWN, r["batch"], packed_places(kept_places[i:j]), packed(kept_tokens[i:j]))
               for r, i, j in zip(bucket, ends[:-1], ends[1:], strict=True) if i < j]
        if out:
            yield rows(out)
    if passed:
        yield rows([tuple(r.values()) for r in passed])


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each batch to its sets with enough shared tokens: (set_id, n, tokens)."""
    for batch in runs(batches, "batch"):
        directory = [r for r in batch if r["kind"] == DIRECTORY][0]
        sizes = np.frombuffer(directory["places"], "<u4")
        known = [r for r in batch if r["kind"] == KNOWN]
        places = unpacked_places([r["places"] for r in known])
        tokens = np.concatenate([shingles.NONE, *unpacked([r["tokens"] for r in known])]).view(np.int64)
        count = np.bincount(places, minlength=len(sizes))
        order = np.argsort(places, kind="stable")
        ends = np.cumsum(count)
        out = []
        for i in np.flatnonzero((count >= least_overlap(sizes.astype(np.int64))) & (count > 0)).tolist():
            mine = np.sort(tokens[order[ends[i] - count[i]:ends[i]]])
            out.append((directory["tokens"][16 * i:16 * i + 16], int(sizes[i]), mine))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.list_(pa.int64()))], names=["set_id", "n", "tokens"])


def candidates(docs: DataFrame, total: int) -> DataFrame:
    """(sid, set_id, n, tokens): each distinct set with enough shared tokens, and those tokens."""
    spark = docs.sparkSession
    buckets = max(2, -(-total // BUCKET_TOKENS))
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.select("bytes").mapInArrow(lean(lambda b: deal(b, buckets)), DEALT)
    answered = dealt.repartition(parts, "route").sortWithinPartitions("route").mapInArrow(lean(answer), DEALT)
    found = answered.repartition(parts, "batch").sortWithinPartitions("batch").mapInArrow(
        lean(gather), "set_id binary, n long, tokens array<long>")
    found = stage(found.withColumn("sid", F.monotonically_increasing_id()), "sets")
    first = found.groupBy("set_id").agg(F.min("sid").alias("sid")).select("sid")
    return stage(found.join(first, "sid", "left_semi"), "distinct-sets")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of set ids with their sizes and the size of their overlap."""
    one, two = (sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}")) for x in "ab")
    both = F.size(F.array_intersect("t_a", "t_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", both.alias("both"))


SIMILAR = f"both * 100 >= {PERCENT} * (n_a + n_b - both)"


def min_hashes(tokens, keys: int) -> list:
    """``keys`` min-hashes of a column of token arrays."""
    of = lambda k: F.array_min(F.transform(tokens, lambda t: F.xxhash64(t, F.lit(k))))
    return [of(k) for k in range(keys)]


def components(edges: DataFrame) -> DataFrame:
    """(sid, label): the smallest id of each component, of ids that have edges.

    Every round a label becomes the smallest of its own and its neighbours',
    then the label of that label; both shrink paths, so rounds grow with the
    logarithm of the longest path.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("sid")).agg(F.least(F.min("b"), F.col("sid")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("sid").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("sid")).agg(F.min("l").alias("l"))
        lower = labels.join(near, "sid").select("sid", F.least("label", "l").alias("next"), "label")
        top = labels.select(F.col("sid").alias("next"), F.col("label").alias("top"))
        moved = stage(lower.join(top, "next").select("sid", F.col("top").alias("label"), (F.col("top") != F.col("label")).alias("moved")), "labels")
        labels = moved.select("sid", "label")
        if moved.where("moved").isEmpty():
            return labels


def stars(sets: DataFrame) -> DataFrame:
    """Pairs of a set and the most central set with the same min-hash."""
    share = (F.size("tokens") / F.col("n")).alias("share")
    key = sets.select("sid", share, F.posexplode(F.array(*min_hashes("tokens", KEYS))).alias("k", "h"))
    pivot = key.groupBy("k", "h").agg(
        F.max_by("sid", F.struct("share", -F.col("sid"))).alias("b"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    return key.join(pivot, ["k", "h"]).where("sid <> b").select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct()


def across(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Sets with enough tokens that another group has too, and only those tokens."""
    out = sets.join(labels, "sid", "left").select("sid", "n", "tokens", F.coalesce("label", "sid").alias("g"))
    for _ in range(2):  # a second look: partners have left too
        token = out.select("sid", "g", "n", F.explode("tokens").alias("t"))
        several = token.groupBy("t").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x <> y").select("t")
        out = stage(token.join(several, "t", "left_semi").groupBy("sid", "g", "n").agg(F.collect_list("t").alias("tokens"))
                    .where(F.size("tokens") * 100 >= PERCENT * F.col("n")), "across")
    return out


def part_of(token, parts):
    return F.pmod(F.xxhash64(token), parts).cast("int")


def unions(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(other, part, union) and (other, parts): each group's tokens in parts of about ``UNION``."""
    parts = matrix.groupBy(F.col("h").alias("other")).agg(F.ceil(F.count(F.lit(1)) / UNION).cast("int").alias("parts"))
    split = matrix.withColumnRenamed("h", "other").join(parts, "other").withColumn("part", part_of("t", F.col("parts")))
    return split.groupBy("other", "part").agg(F.collect_list("t").alias("union")), parts


def opened(sets: DataFrame) -> DataFrame:
    """Pairs of sets of different groups ``h`` that the matrix cannot rule out."""
    token = sets.select("sid", "h", "n", F.explode("tokens").alias("t"))
    matrix = stage(token.select("h", "t").distinct(), "matrix")
    spread = matrix.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    need = F.ceil(F.col("n") * PERCENT / 100).cast("int")
    ordered = token.join(spread, "t").groupBy("sid", "h", "n").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("s"))
    rare = stage(ordered.where(F.size("s") >= need).select("sid", "h", "n", F.explode(F.slice("s", F.lit(1), F.size("s") - need + 1)).alias("x"))
                 .select("sid", "h", "n", F.col("x.t").alias("t")), "rare")
    meet = rare.join(matrix.withColumnRenamed("h", "other"), "t").where("h <> other").select("sid", "other").distinct()
    union, parts = unions(matrix.join(spread, "t", "left_semi"))
    of = lambda k: F.when(F.col("parts") == 1, F.col("tokens")).otherwise(
        F.filter("tokens", lambda t: part_of(t, F.col("parts")) == k))
    dealt = (meet.join(sets.select("sid", "n", "tokens"), "sid").join(parts, "other")
             .select("sid", "other", "n", "tokens", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
             .select("sid", "other", "n", "part", of(F.col("part")).alias("tokens")).where(F.size("tokens") > 0))
    bound = F.sum(F.size(F.array_intersect("tokens", "union")))
    overlap = (dealt.join(union, ["other", "part"]).groupBy("sid", "other", "n").agg(bound.alias("bound"))
               .where(F.col("bound") * 100 >= PERCENT * F.col("n")))
    mine = rare.select(F.col("sid").alias("a"), "t", F.col("n").alias("n_a"))
    theirs = rare.select(F.col("sid").alias("b"), "t", F.col("n").alias("n_b"), F.col("h").alias("other"))
    return (overlap.select(F.col("sid").alias("a"), "other").join(mine, "a").join(theirs, ["other", "t"])
            .where((F.col("n_b") * 100 >= PERCENT * F.col("n_a")) & (F.col("n_a") * 100 >= PERCENT * F.col("n_b")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def block_links(key: tuple, sets: pd.DataFrame) -> pd.DataFrame:
    """Links between the sets of two blocks of a group (or inside one), as few as
    join all components that links join."""
    _, x, y = key
    left, right = np.flatnonzero(sets["block"] == x), np.flatnonzero(sets["block"] == y)
    size, part = sets["n"].to_numpy(), sets["g"].to_numpy()
    lengths = [len(t) for t in sets["tokens"]]
    names, column = np.unique(np.concatenate(sets["tokens"].to_list()), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for at in range(0, len(names), COLUMNS):
        i, j = np.searchsorted(column, (at, at + COLUMNS))
        matrix = np.zeros((len(sets), min(COLUMNS, len(names) - at)), np.float32)
        matrix[row[i:j], column[i:j] - at] = 1
        both += matrix[left] @ matrix[right].T
    total = size[left][:, None] + size[right][None, :] - both
    hit = (both * 100 >= PERCENT * total) & (part[left][:, None] != part[right][None, :])
    top = {g: g for g in part.tolist()}

    def root(g: int) -> int:
        while top[g] != g:
            top[g] = g = top[top[g]]
        return g

    out, ids = [], sets["sid"].to_numpy()
    for i, j in zip(*np.nonzero(hit), strict=True):
        a, b = root(int(part[left[i]])), root(int(part[right[j]]))
        if a != b:
            top[b] = a
            out.append((ids[left[i]], ids[right[j]]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def group_links(sets: DataFrame) -> DataFrame:
    """Links inside groups ``h`` between components ``g``, block pair by block pair."""
    sized = sets.groupBy("h").agg(F.min("g").alias("x"), F.max("g").alias("y"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = sets.join(sized.where("x <> y").select("h", "blocks"), "h").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("sid", "g", "n", "tokens", "block", "h", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    return rows.groupBy("h", "i", "j").applyInPandas(block_links, "a long, b long")


def linked(facts: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sid, set_id) of the sets that others may link to, and (sid, label) of those linked."""
    total = facts.agg(F.sum("n_shingles")).first()[0] or 0
    sets = candidates(docs, total)
    star = stage(compared(stars(sets), sets), "compared")
    links = star.where(SIMILAR).select("a", "b")
    fields = components(star.where("both * 2 >= least(n_a, n_b)")).withColumnRenamed("label", "h")
    left = across(sets, components(links)).join(fields, "sid", "left").withColumn("h", F.coalesce("h", "sid"))
    left = stage(left, "left")
    far = compared(opened(left), left).where(SIMILAR).select("a", "b")
    return sets.select("sid", "set_id"), components(links.union(group_links(left)).union(far))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, the document's
    own included.  Null texts and texts without words have the empty set, are
    linked with nothing and are their own component.  Null ids never win over
    others; repeated ids and rows are rows of their own.  An empty table gives
    an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    docs = columns(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    facts = stage(docs.mapInArrow(lean(described), "doc_id long, n_shingles long, set_id binary"), "described")
    return labelled(facts, *linked(facts, docs))


def labelled(facts: DataFrame, sets: DataFrame, label: DataFrame) -> DataFrame:
    lowest = facts.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("first"))
    named = lowest.join(sets.join(label, "sid").select("set_id", "label"), "set_id", "left")
    reach = named.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("first").alias("component"))
    by_set = named.join(reach, "label", "left").select("set_id", F.coalesce("component", "first").alias("component"))
    return facts.join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest
    id (rows without id last), of those the first.  Rows are told apart by a tag
    written with them, so repeated and null ids are rows of their own."""
    prepare(docs.sparkSession)
    tagged, tag = tag_rows(docs)
    rows = columns(tagged, id_col, text_col, F.col(tag).alias(TAG)).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"), TAG)
    facts = stage(rows.mapInArrow(lean(described), f"doc_id long, n_shingles long, set_id binary, {TAG} {TAG_TYPE}"), "described")
    sets, label = linked(facts, rows)
    first = facts.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", TAG)).alias("first"))
    named = first.join(sets.join(label, "sid").select("set_id", "label"), "set_id", "left")
    alone = named.where(F.col("label").isNull()).select("first")
    heads = named.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("first").alias("first")).select("first")
    kept = alone.union(heads).select(F.col(f"first.{TAG}").alias(TAG))
    gone = facts.where(F.col("set_id").isNotNull()).join(kept, TAG, "left_anti").select(F.col(TAG).alias(tag))
    return tagged.join(stage(gone, "dropped"), tag, "left_anti").select(docs.columns)
