"""Record content hash (F1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .dates import parse_date, strip


def _key_text(name: str) -> Column:
    """Key as trimmed text; null becomes 'nan' so that different keys never
    collapse onto the same joined string."""
    return F.coalesce(strip(F.col(name).cast("string")), F.lit("nan"))


def normalized_date_text(name: str) -> Column:
    """Date part yyyy-MM-dd when the value parses, else the trimmed raw text."""
    raw = _key_text(name)
    return F.coalesce(F.date_format(parse_date(F.col(name)), "yyyy-MM-dd"), raw)


def record_hash(key_fields: list[str] | None = None) -> Column:
    keys = key_fields or C.HASH_KEY_FIELDS
    parts = [normalized_date_text(k) if k == "first_visit_date" else _key_text(k) for k in keys]
    return F.md5(F.concat_ws(C.HASH_SEPARATOR, *parts))
