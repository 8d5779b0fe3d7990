"""Behaviour scores (F11-F13) as Column builders; same term order as the
original so floating sums agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _weighted(terms, serve: bool, cols: dict[str, Column] | None = None) -> Column:
    total = None
    for name, w in terms:
        c = (cols or {}).get(name, F.col(name))
        if serve:
            c = F.coalesce(c, F.lit(0))
        t = c * F.lit(w)
        total = t if total is None else total + t
    return total.cast("double")


def engagement_score(serve: bool = False, cols: dict[str, Column] | None = None) -> Column:
    return _weighted(C.ENGAGEMENT_WEIGHTS, serve, cols)


def purchase_intent(serve: bool = False, cols: dict[str, Column] | None = None) -> Column:
    return _weighted(C.INTENT_WEIGHTS, serve, cols)


def screen_diversity(cols: dict[str, Column] | None = None) -> Column:
    """Number of screen categories with at least one screen (0..4)."""
    total = None
    for name in C.SCREEN_CATEGORIES:
        t = ((cols or {}).get(name, F.col(name)) > 0).cast("int")
        total = t if total is None else total + t
    return total.cast("int")
