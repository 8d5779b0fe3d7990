"""Date parsing and time features (F2, F3, F5-F7, F22) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column) -> Column:
    """Text without white space (blanks, tabs, line ends) at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_date(c) -> Column:
    """Permissive parse to TIMESTAMP_NTZ; unparsable or null text -> null.

    ISO text first (with or without time, surrounding white space ignored),
    then the declared formats, month first, each with or without a time of
    day. Never raises under ANSI mode.
    """
    s = strip(_col(c).cast("string"))
    tries = [s.try_cast("timestamp_ntz")]
    for fmt in C.DATE_FORMATS_SPARK:
        tries.append(F.try_to_timestamp(s, F.lit(fmt + C.TIME_SUFFIX_SPARK)).cast("timestamp_ntz"))
    return F.coalesce(*tries)


def hours_between(start, end) -> Column:
    """Fractional hours from ``start`` to ``end`` (microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def purchase_label(first_visit, purchase) -> Column:
    """1 when the purchase is at most 24 h after the visit (also when it is
    before the visit), 0 when absent or unparsable."""
    h = hours_between(first_visit, purchase)
    return F.when(h <= F.lit(float(C.LABEL_HORIZON_HOURS)), 1).otherwise(0).cast("int")


def hour_of_day(ts, serve: bool = False) -> Column:
    h = F.hour(_col(ts))
    return (F.coalesce(h, F.lit(C.SERVE_DEFAULT_HOUR)) if serve else h).cast("int")


def day_of_week(ts, serve: bool = False) -> Column:
    """Monday = 0 ... Sunday = 6."""
    d = F.weekday(_col(ts))
    return (F.coalesce(d, F.lit(C.SERVE_DEFAULT_DAYOFWEEK)) if serve else d).cast("int")


def is_weekend(dow) -> Column:
    return F.coalesce(_col(dow).isin(*C.WEEKEND_DAYS), F.lit(False)).cast("int")


def whole_days_between(start, end) -> Column:
    """Whole days elapsed (floor of the time difference)."""
    return F.floor(F.timestamp_diff("SECOND", _col(start), _col(end)) / F.lit(86400)).cast("long")
