"""Data-quality and statistics operators.

Each fuses its per-column aggregates into a single ``agg`` (one scan), then
turns the one-row result into long form with ``stack``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import stored

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric (not boolean) columns, like a 'number' dtype selection."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _lit_name(c: str) -> str:
    return "'" + c.replace("'", "\\'") + "'"


def _bt(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _long_form(one_row: DataFrame, names: list[str], value_cols: list[list[str]], out: list[str]) -> DataFrame:
    """stack(n, name, v1, v2, ..., name, ...) over a one-row frame."""
    args = []
    for n, vals in zip(names, value_cols):
        args.append(_lit_name(n))
        args.extend(_bt(v) for v in vals)
    expr = f"stack({len(names)}, {', '.join(args)}) AS ({', '.join(out)})"
    return one_row.select(F.expr(expr))


def null_report(df: DataFrame) -> DataFrame:
    """Null count and share per column with at least one null (A4, A5), plus
    the number of rows with any null under the name '*'."""
    cols = df.columns
    any_null = None
    for c in cols:
        t = F.col(c).isNull()
        any_null = t if any_null is None else any_null | t
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)]
    aggs.append(F.count_if(any_null).alias("__any"))
    one = df.agg(*aggs)
    names = cols + ["*"]
    vals = [[f"__null_{i}", "__n"] for i in range(len(cols))] + [["__any", "__n"]]
    long = _long_form(one, names, vals, ["column_name", "null_count", "row_count"])
    return long.where(F.col("null_count") > 0).select(
        "column_name", F.col("null_count").cast("long"),
        F.round(F.col("null_count") * 100.0 / F.col("row_count"), 6).alias("null_pct"))


def sparse_columns(df: DataFrame, max_share: float = C.MAX_MISSING_SHARE) -> DataFrame:
    """Every column with its null share; ``dropped`` when share > max (P10)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)])
    long = _long_form(one, cols, [[f"__null_{i}", "__n"] for i in range(len(cols))],
                      ["column_name", "null_count", "row_count"])
    share = F.try_divide(F.col("null_count").cast("double"), F.col("row_count"))
    return long.select("column_name", F.round(share, 6).alias("null_share"),
                       (share > F.lit(max_share)).alias("dropped"))


def date_like_columns(df: DataFrame, pattern: str = C.DATE_LIKE_PATTERN) -> DataFrame:
    """String columns where any value contains a date-like text."""
    cols = string_columns(df)
    one = df.agg(*[F.coalesce(F.bool_or(F.regexp_like(F.col(c), F.lit(pattern))), F.lit(False)).alias(f"__d{i}")
                   for i, c in enumerate(cols)])
    return _long_form(one, cols, [[f"__d{i}"] for i in range(len(cols))], ["column_name", "date_like"])


def _corr(x: Column, y: Column) -> Column:
    """Pearson correlation over pairwise-complete rows; null when either side
    is constant (never raises)."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


#: Aggregates that one pass computes: the generated code of many at once is too
#: long for the JVM to compile, and runs many times slower than their sum.
WIDTH = 8


def wide_agg(df: DataFrame, aggs: dict[str, Column], width: int = WIDTH) -> DataFrame:
    """One row of many aggregates by name, ``width`` of them in a pass that reads
    only their columns."""
    names = list(aggs)
    groups = [names[i:i + width] for i in range(0, len(names), width)]
    # written, as the planner would put the passes together again
    parts = [stored(df.agg(*[aggs[n].alias(n) for n in g]), "wide") for g in groups]
    return reduce(DataFrame.crossJoin, parts)


def label_correlation(df: DataFrame, label: str = C.TARGET, top: int | None = C.TOP_CORRELATIONS) -> DataFrame:
    """Correlation of every numeric column with the label, highest first
    (A7, T1). Only the label's column of the matrix: O(k) aggregates."""
    cols = numeric_columns(df)
    y = F.col(label).cast("double")
    one = wide_agg(df, {f"__c{i}": _corr(F.col(c).cast("double"), y) for i, c in enumerate(cols)})
    long = _long_form(one, cols, [[f"__c{i}"] for i in range(len(cols))], ["feature", "correlation"])
    long = long.select("feature", F.round("correlation", 6).alias("correlation"))
    if top is None:
        return long
    return long.orderBy(F.col("correlation").desc_nulls_last(), "feature").limit(top)


#: Values of the grid that a selection pass takes from inside a bracket, and the
#: sketch's accuracy behind it.
GRID, ACCURACY = 100, 10_000


@dataclass
class Sought:
    """A rank that is looked for in a column: the value lies in [low, high];
    ``outer`` is a bracket around it that holds the value for sure."""
    column: str
    rank: int
    low: float
    high: float
    outer: tuple[float, float]
    value: float | None = None

    def narrow(self, lt_low: int, le_low: int, lt_high: int, le_high: int, grid: list[float] | None) -> None:
        """Use the counts of values below and up to both ends, and a grid of
        quantiles of the values between them."""
        if self.rank < lt_low or self.rank >= le_high:  # the sketch was off: look beside the bracket
            below = self.rank < lt_low
            self.low, self.high = (self.outer[0], self.low) if below else (self.high, self.outer[1])
        elif self.rank < le_low:
            self.value = self.low
        elif self.rank >= lt_high:
            self.value = self.high
        else:
            at = (self.rank - le_low) / (lt_high - le_low) * GRID
            self.outer = (self.low, self.high)
            self.low, self.high = grid[max(0, int(at) - 1)], grid[min(GRID, int(at) + 2)]


def order_statistics(df: DataFrame, cols: list[str], share: float) -> dict[str, tuple[float, float] | None]:
    """Exact values at the ranks floor and ceil of ``share`` * (n - 1) of each
    column, nulls and NaN left out; None for a column without values.

    Selection by narrowing brackets: every pass is one aggregate over all columns
    at once, which counts the values around each bracket and takes a mergeable
    sketch of those inside it, so a bracket loses all but about 1 / ``GRID`` of
    its values. There is no shuffle of rows, no sort and no list of values; the
    driver holds a few numbers for each column. Ten billion values take about eight
    passes."""
    if not cols:
        return {}
    x = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    first = df.agg(*[e for i, c in enumerate(cols) for e in (F.count(x[c]).alias(f"n{i}"), F.min(x[c]).alias(f"lo{i}"), F.max(x[c]).alias(f"hi{i}"))]).first()
    out: dict[str, list[Sought]] = {}
    for i, c in enumerate(cols):
        n, lo, hi = first[f"n{i}"], first[f"lo{i}"], first[f"hi{i}"]
        out[c] = [Sought(c, k, lo, hi, (lo, hi)) for k in sorted({math.floor(share * (n - 1)), math.ceil(share * (n - 1))})] if n else []
    grid = [k / GRID for k in range(GRID + 1)]
    while left := [s for ss in out.values() for s in ss if s.value is None]:
        aggs = []
        for i, s in enumerate(left):
            v = x[s.column]
            low, high = F.lit(s.low), F.lit(s.high)
            aggs += [F.count_if(v < low).alias(f"a{i}"), F.count_if(v <= low).alias(f"b{i}"), F.count_if(v < high).alias(f"c{i}"),
                     F.count_if(v <= high).alias(f"d{i}"), F.percentile_approx(F.when((v > low) & (v < high), v), grid, ACCURACY).alias(f"g{i}")]
        row = df.agg(*aggs).first()
        for i, s in enumerate(left):
            s.narrow(*[row[f"{k}{i}"] for k in "abcd"], row[f"g{i}"])
    return {c: (ss[0].value, ss[-1].value) if ss else None for c, ss in out.items()}


def medians(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float | None]:
    """Median of each column, None without values; ``exact=False`` stops at the
    mergeable ``percentile_approx`` sketch."""
    if exact:
        return {c: None if v is None else (v[0] + v[1]) / 2 for c, v in order_statistics(df, cols, 0.5).items()}
    row = df.agg(*[F.percentile_approx(F.col(c), 0.5, ACCURACY).cast("double").alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def column_medians(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """(feature, median) of each numeric column (A8), null for a column without values."""
    cols = cols or numeric_columns(df, exclude=tuple(C.ID_COLUMNS) + (C.TARGET,))
    return df.sparkSession.createDataFrame(list(medians(df, cols, exact).items()), "feature string, median double")


def medians_struct(df: DataFrame, cols: list[str], exact: bool = True) -> Column:
    """The medians as one struct of literals."""
    return F.struct(*[F.lit(v).cast("double").alias(c) for c, v in medians(df, cols, exact).items()])


def feature_run_stats(features: DataFrame, raw_columns: list[str] | None = None) -> DataFrame:
    """Run record of a featurization (S11, A2, A6): one aggregate row."""
    has_label = C.TARGET in features.columns
    return features.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("user_id").alias("id_count"),
        (F.round(F.avg(C.TARGET), 6) if has_label else F.lit(None).cast("double")).alias("purchase_rate"),
        F.max("log_ts").alias("last_processed_timestamp"),
    ).select("*", F.lit(len(features.columns)).cast("long").alias("feature_count"),
             F.lit("retail").alias("domain"))


def batch_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of all rows (A18): the row count and the sum of
    60 bits of each row's md5, taken modulo 2^31 before summing so that the sum
    stays exact. Equal content gives an equal fingerprint no matter how the
    rows are partitioned, in any engine that has md5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("record_count"), F.coalesce(F.sum(F.pmod(bits, F.lit(1 << 31))), F.lit(0)).alias("fingerprint"))
