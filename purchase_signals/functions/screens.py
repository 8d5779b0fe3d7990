"""Screen-list features (F8-F10) as Column builders."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# Columns of the screens' mergeable state (see ``screen_state``).
SEEN, UNTRACKED, BLANK = STATE = ("screens_seen", "screens_untracked", "screens_blank")


def flag_name(screen: str) -> str:
    return screen.lower()


def screen_flags(screen_list) -> dict[str, Column]:
    """One 0/1 column per tracked screen: case-sensitive *substring* match on
    the comma-joined list (so 'SearchResults' also sets 'search'). Null list
    -> all 0."""
    s = F.coalesce(F.col(screen_list) if isinstance(screen_list, str) else screen_list, F.lit(""))
    return {flag_name(n): s.contains(n).cast("int") for n in C.TRACKED_SCREENS}


def screen_state(screen) -> dict[str, Column]:
    """Mergeable state of one screen name: the tracked names in it as bits (to
    be merged by ``bit_or``) and what it adds to the untracked and to the blank
    tokens (to be summed).  No tracked name holds a comma, so the merged state
    of many names gives the flags and counts of their comma-joined list."""
    s = F.coalesce(F.col(screen) if isinstance(screen, str) else screen, F.lit(""))
    bits = F.lit(0).cast("long")
    for i, name in enumerate(C.TRACKED_SCREENS):
        bits = bits + F.when(s.contains(name), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    others = other_screens(s)
    return {SEEN: bits, UNTRACKED: others.cast("long"), BLANK: (others - other_screens(s, serve=True)).cast("long")}


def flags_of_state() -> dict[str, Column]:
    """The 0/1 columns of ``screen_flags`` from a merged state."""
    return {flag_name(n): F.shiftright(F.coalesce(F.col(SEEN), F.lit(0)), i).bitwiseAND(1).cast("int")
            for i, n in enumerate(C.TRACKED_SCREENS)}


def others_of_state(serve: bool = False) -> Column:
    """``other_screens`` from a merged state."""
    n = F.coalesce(F.col(UNTRACKED), F.lit(0))
    return (n - F.coalesce(F.col(BLANK), F.lit(0)) if serve else n).cast("int")


def category_counts() -> dict[str, Column]:
    """Per category, how many of its screens were seen (sum of flags)."""
    out = {}
    for name, screens in C.SCREEN_CATEGORIES.items():
        total = None
        for s in screens:
            c = F.col(flag_name(s))
            total = c if total is None else total + c
        out[name] = total.cast("int")
    return out


def other_screens(screen_list, serve: bool = False) -> Column:
    """Count of comma tokens (repeats included) that are non-empty and not
    *exactly* a tracked name. Serving also skips blank tokens.

    One regular expression counted per row (stays in generated code): a
    match starts at a token boundary, is not a tracked name followed by a
    boundary, and takes the whole token."""
    s = F.coalesce(F.col(screen_list) if isinstance(screen_list, str) else screen_list, F.lit(""))
    names = "|".join(re.escape(n) for n in C.TRACKED_SCREENS)
    blank = r"(?!\s+(?:,|\z))" if serve else ""
    pattern = rf"(?<=^|,)(?!(?:{names})(?:,|\z)){blank}[^,]+"
    return F.regexp_count(s, F.lit(pattern)).cast("int")
