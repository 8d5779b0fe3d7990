"""Packing documents into token sequences by order-preserving dynamic programming.

Documents keep the order in which their input split stores them; a split is
packed on its own, so no row is shuffled and a retried task gives the same
pieces.  A split's token stream is cut into windows of at most ``WIDTH`` ids.
Cuts are chosen among document ends, sentence ends and, inside sentences longer
than ``STRIDE`` ids, every ``STRIDE``-th id.  With b the cut positions, the cost
of the best packing that ends at cut j is

    f(j) = min over i, b(j) - b(i) <= WIDTH, of f(i) + WIDTH - (b(j) - b(i)) + penalty(j)

i.e. padding plus a truncation penalty.  f(i) + b(i) does not depend on j, so
the minimum over the moving range of i is the head of a monotone queue and each
cut is pushed and popped once.  The stream is handled in blocks of about
``BLOCK`` ids; the last open window of a block is carried into the next one, so
only the end of a split can need padding, and there the rest may also be cut
into windows of power-of-two length, which need none.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import columns, lean, prepare

WIDTH = 4096
STRIDE = 64
BLOCK = 1 << 20
END_ID = 2
#: Penalty in padded ids of a cut inside a document.
SENTENCE_CUT, HARD_CUT = 4, 32
CACHE_WORDS = 400_000

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

#: A word of plain Latin letters with plain punctuation behind it: its
#: normal form is its lower case, and letters and punctuation are one piece each.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?&%$#*()\"|+-]{0,4})")


def byte_symbols() -> dict[str, int]:
    """The byte behind each symbol of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PlainWords:
    """The same merges run by tiktoken, for words of plain letters.

    A word's end is the byte 0, which no such word has; it joins the last byte
    first.  Merging neighbours by the rank of what they make gives the
    tokenizer's ids because each of its tokens, taken as a word, is encoded as
    itself: neighbours that make a token always are the two parts of its merge
    (tests check that for the whole vocabulary).
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = byte_symbols()

        def raw(token: str) -> bytes:
            return bytes(map(byte.__getitem__, token.removesuffix("</w>"))) + b"\0" * token.endswith("</w>")

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ends = [c + "</w>" for c in byte]
        order = [*ends, *(a + b for a, b in pairs), *byte]
        ranks: dict[bytes, int] = {}
        self.ids = np.zeros(len(order) + 1, "<u4")
        self.ends = np.array([*(token.endswith("</w>") for token in order), True])
        for k, token in enumerate(order):
            if raw(token) not in ranks:
                ranks[raw(token)] = k
                self.ids[k] = model["vocab"][token]
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word, in one call."""
        if not words:
            return []
        got = np.array(self.encoding.encode_ordinary("\0".join(words) + "\0"))
        data = self.ids[got].tobytes()
        stops = ((np.flatnonzero(self.ends[got]) + 1) * 4).tolist()
        return [data[i:j] for i, j in zip([0, *stops], stops, strict=False)]


class WordIds(dict):
    """Ids (little-endian unsigned 32-bit) by white-space separated word.

    The tokenizer drops white space and never looks across it, so a text's ids
    are its words' ids in a row; words repeat, so most are found here.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(path)
        self.marks: dict[str, bytes] = {"": b""}
        vocab = self.tokenizer.get_vocab()
        self.sentence_end = np.zeros(max([END_ID, *vocab.values()]) + 1, bool)
        for token, i in vocab.items():
            self.sentence_end[i] = bool(re.fullmatch(r"\W*[.!?]\W*</w>", token))

    def encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def mark(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self.encode(marks)
        return self.marks[marks]

    def learn(self, words: list[bytes]) -> None:
        """Make sure that every word is a key."""
        new = [w for w in set(words) if w not in self]
        if new and len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(set(words))
        texts = [w.decode() for w in new]
        plain = [PLAIN.fullmatch(t) if len(t) < 60 else None for t in texts]
        stems = iter(self.plain.encode([p[1].lower() for p in plain if p]))
        for w, t, p in zip(new, texts, plain, strict=True):
            self[w] = next(stems) + self.mark(p[2]) if p else self.encode(t)

    def text(self, text: str | None) -> np.ndarray:
        """The ids of a whole text with ``END_ID`` behind them."""
        words = (text or "").encode().split()
        self.learn(words)
        return np.frombuffer(b"".join(map(self.__getitem__, words)) + END_ID.to_bytes(4, "little"), "<u4")


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def cut_positions(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, ascending, and the penalty of each."""
    ends = np.flatnonzero(sentence_end[ids]) + 1
    base = np.union1d(ends, doc_ends)
    gaps = np.diff(base, prepend=0)
    extra = [np.arange(e - g + STRIDE, e, STRIDE) for e, g in zip(base[gaps > STRIDE], gaps[gaps > STRIDE], strict=True)]
    cuts = np.union1d(base, np.concatenate(extra)) if extra else base
    penalty = np.full(len(cuts), HARD_CUT)
    penalty[np.searchsorted(cuts, ends)] = SENTENCE_CUT
    penalty[np.searchsorted(cuts, doc_ends)] = 0
    return cuts.astype(np.int64), penalty


def best_windows(cuts: list[int], penalty: list[int], last: bool) -> list[int]:
    """The ends of the windows of least cost.  ``last``: the stream ends at the
    last cut; otherwise the rest behind the last end returned stays open."""
    at, cost, back = [0, *cuts], [0.0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    queue = deque([(0.0, 0)])
    for j in range(1, len(at)):
        b = at[j]
        while at[queue[0][1]] < b - WIDTH:
            queue.popleft()
        least, i = queue[0]
        cost[j] = c = least + WIDTH - b + penalty[j - 1]
        back[j] = i
        key = c + b
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    n, total = len(at) - 1, at[-1]
    open_from = range(max(0, n - 1), -1, -1)
    reach = [i for i in takewhile_from(open_from, at, total - WIDTH)]
    if last:
        rest = lambda i: min(tail_cost(total - at[i]))
        j = min(reach, key=lambda i: (cost[i] + rest(i), i)) if n else 0
    else:
        j = min(reach, key=lambda i: (cost[i], i)) if n else 0
    ends = []
    while j > 0:
        ends.append(at[j])
        j = back[j]
    ends.reverse()
    if last and n:
        begin, length = (ends[-1] if ends else 0), total - (ends[-1] if ends else 0)
        if tail_cost(length)[0] <= tail_cost(length)[1]:
            ends.append(total)
        else:
            for k in range(length.bit_length() - 1, -1, -1):
                if length >> k & 1:
                    begin += 1 << k
                    ends.append(begin)
    return ends


def takewhile_from(indices, at: list[int], least: int) -> Iterator[int]:
    for i in indices:
        if at[i] < least:
            return
        yield i


def tail_cost(length: int) -> tuple[int, int]:
    """Cost of the last ``length`` ids as one padded window, and as windows of
    power-of-two length."""
    return (0 if length & (length - 1) == 0 else WIDTH - length), (length.bit_count() - 1) * HARD_CUT


def pieces(docs: list[tuple], ends: list[int], first: int, start: int = 0) -> list[tuple]:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of the
    documents (doc_id, ids, ids used before) laid out in windows ending at ``ends``."""
    out, d, used, at = [], 0, 0, start
    for k, end in enumerate(ends):
        begin = at
        while at < end:
            doc_id, ids, before = docs[d]
            n = min(len(ids) - before - used, end - at)
            s = before + used
            out.append((doc_id, s, n, ids[s:s + n].tobytes(), len(ids), first + k, at - begin))
            at, used = at + n, used + n
            if s + n == len(ids):
                d, used = d + 1, 0
    return out


def pack_split(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    words = word_ids(path)
    sequence = TaskContext.get().partitionId() << 40
    held: list[tuple] = []  # (doc_id, ids, ids already placed)
    size = 0

    def place(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal sequence, held, size
        ids = np.concatenate([d[1][d[2]:] for d in held])
        doc_ends = np.cumsum([len(d[1]) - d[2] for d in held])
        cuts, penalty = cut_positions(ids, doc_ends, words.sentence_end)
        ends = best_windows(cuts.tolist(), penalty.tolist(), last)
        rows = pieces(held, ends, sequence)
        sequence += len(ends)
        done = ends[-1] if ends else 0
        k = int(np.searchsorted(doc_ends, done, side="right"))
        rest = held[k:]
        if rest:
            rest[0] = (rest[0][0], rest[0][1], rest[0][2] + done - (int(doc_ends[k - 1]) if k else 0))
        held, size = rest, len(ids) - done
        for i in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[i:i + 4096], strict=True), _ARROW, strict=True)], schema=_ARROW)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = words.text(text.as_py())
            held.append((doc_id, ids, 0))
            size += len(ids)
            if size >= BLOCK:
                yield from place(False)
    if held:
        yield from place(True)
    words.clear()  # a worker goes on to other stages


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece.  Null text counts as
    empty: its document is the single id 2.  Null ids, repeated ids and repeated
    rows are documents of their own.  An empty table gives an empty result;
    other columns are ignored.  Sequence ids are unique, not consecutive:
    the input split's number times 2**40 plus a count.
    """
    prepare(docs.sparkSession)
    return columns(docs, id_col, text_col).mapInArrow(lean(lambda batches: pack_split(batches, tokenizer)), SCHEMA)
