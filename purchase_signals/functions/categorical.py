"""Categorical features (F14-F18) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def platform_code(c, serve: bool = False) -> Column:
    """iOS -> 1, Android -> 0, anything else -> null (training) or 0 (serving)."""
    p = _col(c)
    out = None
    for name, code in C.PLATFORM_CODES.items():
        out = (F.when(p == F.lit(name), F.lit(code)) if out is None else out.when(p == F.lit(name), F.lit(code)))
    if serve:
        out = out.otherwise(F.lit(0))
    return out.cast("int")


def age_group(segment, serve: bool = False) -> Column:
    """First whitespace-separated word (null when there is none)."""
    seg = _col(segment)
    if serve:
        seg = F.coalesce(seg, F.lit(C.SERVE_DEFAULT_SEGMENT))
    return F.nullif(F.regexp_extract(seg, r"^\s*(\S+)", 1), F.lit(""))


def user_type(segment, serve: bool = False) -> Column:
    """Words after the first, joined by one space (like ' '.join(s.split()[1:])).
    Serving: 'User' when the segment has a single word."""
    seg = _col(segment)
    if serve:
        seg = F.coalesce(seg, F.lit(C.SERVE_DEFAULT_SEGMENT))
    rest = F.regexp_extract(seg, r"(?s)^\s*\S+(.*)$", 1)
    rest = F.regexp_replace(F.regexp_replace(rest, r"^\s+|\s+$", ""), r"\s+", " ")
    if serve:
        rest = F.when(rest != F.lit(""), rest).otherwise(F.lit(C.SERVE_DEFAULT_USER_TYPE))
    return rest


def one_hot_name(prefix: str, value: str) -> str:
    """Lower-case column name; dots and backticks, which a name cannot be
    addressed with, become underscores."""
    return f"{prefix}_{value}".lower().replace(".", "_").replace("`", "_")


def one_hot(c, prefix: str, values: list[str]) -> dict[str, Column]:
    """One boolean column per vocabulary value; null or unseen -> all false.
    Values of one name (they differ in case only) share a column."""
    x = _col(c)
    by_name: dict[str, list[str]] = {}
    for v in values:
        by_name.setdefault(one_hot_name(prefix, v), []).append(v)
    return {name: F.coalesce(x.isin(vs) if len(vs) > 1 else x == F.lit(vs[0]), F.lit(False)) for name, vs in by_name.items()}


def _version_parts(v) -> Column:
    return F.split(_col(v), r"\.", -1)


def app_major_version(v, serve: bool = False) -> Column:
    """Integer before the first dot; null when not an integer (training) or 3
    (serving)."""
    major = F.trim(F.get(_version_parts(v), 0)).try_cast("int")
    if serve:
        major = F.coalesce(major, F.lit(C.SERVE_DEFAULT_MAJOR_VERSION))
    return major.cast("int")


def version_score(v, serve: bool = False) -> Column:
    """Sum of part_n / 10^n (n from 0) over all parts: '3.10.1' -> 4.01. Any
    bad part -> null (training) or 3.0 (serving). From part 309 on the divisor
    leaves the range of a double and a part adds nothing."""
    terms = F.transform(_version_parts(v), lambda p, n: F.trim(p).try_cast("double") / F.pow(F.lit(10.0), n.cast("double")))
    score = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    if serve:
        score = F.coalesce(score, F.lit(C.SERVE_DEFAULT_VERSION_SCORE))
    return score.cast("double")
