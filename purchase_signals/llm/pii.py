"""Personal data: base patterns and a tagger that adds to them.

The base spans are the leftmost non-overlapping matches of four patterns that
pass their checks.  The tagger (a character-level bidirectional LSTM with CRF
transitions, see ``tagger``) finds what the patterns cannot: spans written with
brackets, spaces, line ends or other separators.  It is trained on windows of
texts as they are, labelled with their base spans, and on windows of altered
copies, in which every base span is rewritten in one of these forms (``altered``)
and keeps its label.  It reads the whole text in overlapping windows.  Every character takes its tag
from the window it is most central in, so the tags of a text are one sequence
and spans may run across windows; spans that touch a base span give way to it.

Every kind needs a digit, an @ or a bracket within the reach of its characters,
so windows without any are all outside and are not decoded.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, lean, prepare, stage
from .tagger import DIGIT, KINDS, MARKS, Tagger, class_table, train

STEP, MARGIN = 64, 16
WINDOW = STEP + 2 * MARGIN
#: Bound on the labelled rows the tagger is fitted to: windows, of at most about so many documents.
MAX_DOCS, MAX_WINDOWS = 4000, 4500
BATCH = 1024

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match within a run of digits could not begin later than the run: what must
# follow is the same, hence the look-behind and the possessive repeats.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@\[({]")
TRIGGER_CLASSES = np.array([DIGIT, *(MARKS.index(c) + 1 for c in "@[({")], np.uint8)
# An @ and a dot as altered spans write them.
AT = re.compile(r"\s*(?:[\[({]\s*(?:at|@)\s*[\])}]|@)\s*", re.IGNORECASE)
DOT = re.compile(r"\s*(?:[\[({]\s*(?:dot|\.)\s*[\])}]|\.)\s*", re.IGNORECASE)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: How the training rewrites the @ and dots of emails, the dots of addresses and the gaps of numbers.
AT_FORMS = (" (at) ", "(at)", "[at]", " [at] ", "{at}", " @ ", "@\n")
DOT_FORMS = (".", ".", " (dot) ", "[dot]", " [dot] ", " . ", "[.]")
IP_FORMS = ("[.]", " . ", "(.)", "[dot]", ".\n", " .")
CARD_FORMS = (".", "/", "\n", " - ", "_", "\u00a0", "  ", ":")
PHONE_FORMS = ("/", "\u00a0", "\n", " / ", ":", "_", " ", "-")
PHONE_STARTS = ("+", "00", "+ ", "(+", "")

Span = tuple[str, int, int]
SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches by their @: the local part is the run of its characters in front."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Base spans by kind as in ``KINDS``, then start."""
    out: list[Span] = [("email", s, e) for s, e in emails(text)]
    if not re.search("[0-9]", text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start():
            d = digits_of(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


_TABLE: list[np.ndarray] = []


def classes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(class_table())
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return _TABLE[0][np.minimum(points, len(_TABLE[0]) - 1)]


def windows(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first position of each window's middle, classes of each window) where a
    digit, an @ or an opening bracket is in the window.  Positions outside the text are class 0."""
    blocks = -(-len(c) // STEP)
    padded = np.zeros(blocks * STEP + 2 * MARGIN, np.uint8)
    padded[MARGIN:MARGIN + len(c)] = c
    view = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]
    hit = np.isin(view, TRIGGER_CLASSES).any(1)
    return np.flatnonzero(hit) * STEP, view[hit]


def plausible(kind: str, text: str) -> bool:
    """What a span must have to count as its kind at all, however it is written."""
    if kind == "email":
        return bool(EMAIL.fullmatch(DOT.sub(".", AT.sub("@", text))))
    if kind == "ip":
        plain = DOT.sub(".", text)
        return bool(IP.fullmatch(plain)) and all(len(p) <= 3 and int(p) <= 255 for p in plain.split("."))
    d = digits_of(text)
    if any(c.isalpha() for c in text):
        return False
    return 13 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15


def whole(text: str, s: int, e: int) -> bool:
    """The span cuts through no word or number."""
    return not (s and text[s - 1].isalnum() and text[s].isalnum()) and not (e < len(text) and text[e].isalnum() and text[e - 1].isalnum())


def altered(kind: str, span: str, rng: np.random.Generator) -> str:
    """A base span rewritten in one of the forms that the base patterns miss."""
    pick = lambda forms: forms[int(rng.integers(len(forms)))]
    if kind == "email":
        local, domain = span.split("@")
        return local + pick(AT_FORMS) + domain.replace(".", pick(DOT_FORMS))
    if kind == "ip":
        return span.replace(".", pick(IP_FORMS))
    d = digits_of(span)
    if kind == "card":
        return pick(CARD_FORMS).join(d[i:i + 4] for i in range(0, len(d), 4))
    start, gap = pick(PHONE_STARTS), pick(PHONE_FORMS)
    cut = len(d) - 10 if len(d) > 10 else 0
    parts = [p for p in (d[:cut], d[cut:cut + 3], d[cut + 3:cut + 6], d[cut + 6:]) if p]
    return start + gap.join(parts) + (")" if start == "(+" else "")


def altered_copy(text: str, seed: int = 0) -> tuple[str, list[Span]]:
    """The text with every base span that overlaps no other one altered, and
    where the altered ones are.  The forms depend on the text and ``seed``."""
    rng = np.random.default_rng([seed, zlib.crc32(text.encode())])
    out, at, spans, size = [], 0, [], 0
    for kind, s, e in sorted(base_spans(text), key=lambda x: (x[1], -x[2])):
        if s < at:
            continue
        new = altered(kind, text[s:e], rng)
        out += [text[at:s], new]
        size += s - at
        spans.append((kind, size, size + len(new)))
        size, at = size + len(new), e
    return "".join(out) + text[at:], spans


def tag_spans(tags: np.ndarray) -> list[Span]:
    """Spans of a text's tag sequence: a kind's first tag or a change of kind begins one."""
    on = np.flatnonzero(tags)
    out: list[list] = []
    for i in on.tolist():
        kind, first = KINDS[(tags[i] - 1) // 2], tags[i] % 2 == 1
        if out and out[-1][2] == i and out[-1][0] == kind and not first:
            out[-1][2] = i + 1
        else:
            out.append([kind, i, i + 1])
    return [(k, s, e) for k, s, e in out]


def added_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """The tagger's spans, trimmed, that are plausible, cut no word and touch no base span."""
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.empty(0)
    out = []
    for kind, s, e in tag_spans(tags):
        raw = text[s:e]
        s, e = s + len(raw) - len(raw.lstrip()), e - (len(raw) - len(raw.rstrip()))
        k = int(np.searchsorted(starts, e))
        if s < e and (k == 0 or ends[k - 1] <= s) and whole(text, s, e) and plausible(kind, text[s:e]):
            out.append((kind, s, e))
    return out


def find(texts: list[str], tagger: Tagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by kind, then start, base ones marked."""
    base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
    tags: dict[int, np.ndarray] = {}
    if tagger:
        owner, first, views = [], [], []

        def flush() -> None:
            if views:
                got = tagger.decode(np.concatenate(views).T)[MARGIN:MARGIN + STEP]
                at = 0
                for i, f, v in zip(owner, first, views, strict=True):
                    for k, p in enumerate(f.tolist()):
                        middle = tags[i][p:p + STEP]
                        middle[:] = got[:len(middle), at + k]
                    at += len(v)
            owner.clear(), first.clear(), views.clear()

        held = 0
        for i, t in enumerate(texts):
            if not TRIGGER.search(t):
                continue
            f, v = windows(classes(t))
            tags[i] = np.zeros(len(t), np.int8)
            for a in range(0, len(f), BATCH):
                if held + len(f[a:a + BATCH]) > BATCH:
                    flush()
                    held = 0
                owner.append(i)
                first.append(f[a:a + BATCH])
                views.append(v[a:a + BATCH])
                held += len(first[-1])
        flush()
    out = []
    for i, t in enumerate(texts):
        spans = [(*s, True) for s in base[i]]
        if i in tags:
            spans += [(*s, False) for s in added_spans(t, tags[i], base[i])]
        out.append(sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    return out


def labelled(text: str, spans: list[Span]) -> Iterator[tuple[bytes, bytes]]:
    """All windows of a text that are decoded, as (classes, tags)."""
    if not TRIGGER.search(text):
        return
    tags = np.zeros(len(text) + WINDOW + STEP, np.uint8)
    for kind, s, e in reversed(spans):
        k = KINDS.index(kind)
        tags[MARGIN + s] = 2 * k + 1
        tags[MARGIN + s + 1:MARGIN + e] = 2 * k + 2
    first, views = windows(classes(text))
    for f, v in zip(first.tolist(), views, strict=True):
        yield v.tobytes(), tags[f:f + WINDOW].tobytes()


#: What a training window is of: a text as it is, without or with a span, or an altered copy, with one.
PLAIN, SPAN, ALTERED = 0, 1, 2


def training_windows(text: str) -> Iterator[tuple[bytes, bytes, int]]:
    """(classes, tags, kind of window) of a text and its altered copy."""
    base = base_spans(text) if TRIGGER.search(text) else []
    for x, y in labelled(text, base):
        yield x, y, SPAN if any(y) else PLAIN
    if base:
        for x, y in labelled(*altered_copy(text)):
            if any(y):
                yield x, y, ALTERED


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS,
        max_windows: int = MAX_WINDOWS) -> Tagger | None:
    """Train on all windows of at most about ``max_docs`` texts chosen by a hash
    of the text, or, beyond ``max_windows``, on a third of that of each kind of
    window, chosen by a hash; None if no window has a span."""
    prepare(docs.sparkSession)
    docs = columns(docs, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(1):
                rows = training_windows(t.as_py() or "")
                while part := list(itertools.islice(rows, 4 * BATCH)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in part], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int32()))], names=["x", "y", "of"])

    total = docs.select("doc_id").count()
    parts = 1 << 30
    drawn = docs.where(F.pmod(F.xxhash64("text"), F.lit(parts)) < int(parts * min(1.0, max_docs / max(1, total))))
    rows = drawn.mapInArrow(cut, "x binary, y binary, of int").distinct()
    rows = stage(rows, "pii-windows")
    got = [r for of in (PLAIN, SPAN, ALTERED) for r in rows.where(F.col("of") == of)
           .orderBy(F.xxhash64("x", "y"), "x", "y").limit(max_windows // 3).collect()]
    if not any(r.of for r in got):
        return None
    x = np.stack([np.frombuffer(bytes(r.x), np.uint8) for r in got])
    y = np.stack([np.frombuffer(bytes(r.y), np.uint8) for r in got]).astype(np.int64)
    return train(x, y)


def tag(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end in code points, base or added) of
    every whole text, row by row.  Null and empty texts have no spans; without
    a tagger only base spans are found."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = find([t or "" for t in b.column(1).to_pylist()], tagger)
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in row] for row in spans]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, _SPANS)], names=["doc_id", "spans"])

    return columns(docs, id_col, text_col).mapInArrow(lean(run), SCHEMA)


def masked(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with every span replaced by its kind; spans that overlap become
    one mark of the first one's kind."""
    if not spans:
        return text
    out, at = [], 0
    for kind, s, e, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of its text column masked; all other columns stay."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            clean = [masked(t, s) for t, s in zip(texts, find([t or "" for t in texts], tagger), strict=True)]
            yield b.set_column(at, b.schema.field(at).name, pa.array(clean, b.schema.field(at).type))

    return docs.mapInArrow(lean(run), docs.schema)
