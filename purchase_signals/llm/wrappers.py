"""HTML extraction by wrapper induction.

Each host has a base page, one of the median size of its pages.  Every page's tree
is aligned with its host's base by simple tree matching, on trees in which
neighbours with one label are one slot (a list of paragraphs or links is one
slot however long).  Where trees are so large that matching would take too long,
their upper levels are paired by label and place, and what hangs below is matched.  Over all pages of a host, slots whose text stays the same
are template, slots whose text varies are content.  Menus, adverts and the like
vary too; they are told by element, role and class or id words.  If a page has
an article or main element, the text is taken from there.

A page's blocks carry the base slot they align with; template slots are counted
by host in DataFrame aggregates, and blocks in them are dropped by a join.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom
from .common import prepare, stage

#: A slot is template if at least so many pages align with it and this share of them has the base's text.
LEAST_PAGES, SAME = 5, 0.9
#: Lists of links, in blocks with more than this share of their characters in links, are no text where the page marks no main part.
LINKED = 0.5
#: Trees of up to so many slots are matched as a whole; the upper levels of larger ones are paired by label and place.
MAX_SLOTS = 4000
#: Classes of page size in one doubling, for the median.
SIZE_STEPS = 8

BLOCKS = "array<struct<text:string,slot:int,same:boolean>>"
SLOTS = "array<struct<slot:int,same:boolean,size:int>>"
_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("slot", pa.int32()), ("same", pa.bool_())]))
_SLOTS = pa.list_(pa.struct([("slot", pa.int32()), ("same", pa.bool_()), ("size", pa.int32())]))


def base_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, collapsed tree as JSON)."""
    for b in batches:
        roots = [dom.read(t.as_py() or "")[0] for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([json.dumps(r.flat()) for r in roots], pa.string())], names=["host", "base"])


def without_link_lists(blocks: list[dom.Block]) -> list[dom.Block]:
    """Blocks mostly in links go if they hold several links or stand beside
    another such block; headings stay."""
    mostly = [b.linked > LINKED * len(b.text) and not b.heading for b in blocks]
    near = [False, *mostly, False]
    return [b for i, b in enumerate(blocks) if not (mostly[i] and (b.links > 1 or near[i] or near[i + 2]))]


def blocks_of(page: str, base: dom.Slot | None) -> tuple[list[tuple], list[tuple]]:
    """(text, base slot, same as base) of the page's text blocks, and (base slot,
    same, size) of the slots aligned."""
    root, blocks = dom.read(page)
    aligned: dict[int, tuple[int, bool]] = {}
    slots = []
    if base is not None:
        for b, s in dom.align(base, root, MAX_SLOTS):
            same = b.text == s.text and b.size == s.size
            aligned[id(s)] = (b.id, same)
            if s.size:
                slots.append((b.id, same, s.size))
    if any(b.main for b in blocks):
        blocks = [b for b in blocks if b.main]
    else:
        blocks = without_link_lists(blocks)
    out = [(b.text, *aligned.get(id(b.slot), (-1, False))) for b in blocks]
    used = {slot for _, slot, _ in out}
    return out, [s for s in slots if s[0] in used]


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, host, html, base) to blocks and slots."""
    bases: dict[str, dom.Slot] = {}
    for b in batches:
        blocks, slots = [], []
        for page, base in zip(b.column(3), b.column(4).to_pylist(), strict=True):
            if base and base not in bases:
                if len(bases) >= 256:
                    bases.clear()
                bases[base] = dom.unflat(json.loads(base))
            got = blocks_of(page.as_py() or "", bases.get(base))
            blocks.append([dict(zip(("text", "slot", "same"), x, strict=True)) for x in got[0]])
            slots.append([dict(zip(("slot", "same", "size"), x, strict=True)) for x in got[1]])
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blocks, _BLOCKS), pa.array(slots, _SLOTS)],
                                         names=["page_id", "url", "host", "blocks", "slots"])


def templates(aligned: DataFrame) -> DataFrame:
    """(host, slots): the template slots of hosts whose varying slots hold most of the text."""
    slot = aligned.select("host", F.explode("slots").alias("s")).select("host", "s.*")
    counted = slot.groupBy("host", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("same").alias("equal"), F.sum("size").alias("size"))
    fixed = (F.col("n") >= LEAST_PAGES) & (F.col("equal") >= SAME * F.col("n"))
    return (counted.groupBy("host").agg(
        F.collect_set(F.when(fixed, F.col("slot"))).alias("template"),
        F.sum(F.when(fixed, F.col("size")).otherwise(0)).alias("constant"),
        F.sum(F.when(fixed, 0).otherwise(F.col("size"))).alias("varying"))
        .where((F.size("template") > 0) & (F.col("varying") > F.col("constant"))).select("host", "template"))


def base_pages(rows: DataFrame) -> DataFrame:
    """(host, html): of each host's pages with an element the first by page_id
    among those whose size is nearest to the median, sizes told apart by
    ``SIZE_STEPS`` classes in a doubling."""
    step = F.floor(F.log2(F.length("html")) * SIZE_STEPS).cast("int")
    sized = rows.where(F.col("html").rlike("<[A-Za-z]")).select("host", "page_id", "html", step.alias("step"))
    middle = stage(sized.groupBy("host").agg(F.percentile("step", F.lit(0.5)).alias("middle")), "middles")
    order = F.struct(F.abs(F.col("step") - F.col("middle")), F.col("page_id").isNull(), "page_id", F.xxhash64("html"))
    return sized.join(middle, "host").groupBy("host").agg(F.min_by("html", order).alias("html"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Blocks are in page order, joined by an empty line; white space in a block
    is one space.  Null and empty html and pages without main text give empty
    text.  Pages with a null or host-less url share the host ''.  Repeated rows
    are pages of their own; an empty table gives an empty result; other columns
    are ignored.
    """
    prepare(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col], F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), host.alias("host"), pages[html_col].alias("html"))
    base = stage(base_pages(rows).mapInArrow(base_trees, "host string, base string"), "bases")
    aligned = stage(rows.join(base, "host", "left").select("page_id", "url", "host", "html", "base").mapInArrow(
        align, f"page_id long, url string, host string, blocks {BLOCKS}, slots {SLOTS}"), "aligned")
    any_same = F.exists("blocks", lambda b: b["same"])
    kept = F.filter("blocks", lambda b: ~F.coalesce(b["same"] & F.array_contains("template", b["slot"]), F.lit(False)))
    maybe = aligned.where(any_same).join(templates(aligned), "host", "left").select("page_id", "url", kept.alias("blocks"))
    text = F.concat_ws("\n\n", F.transform("blocks", lambda b: b["text"]))
    out = aligned.where(~any_same).select("page_id", "url", "blocks").unionByName(maybe).select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
