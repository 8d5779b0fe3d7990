"""Training-set preparation.

The split is a deterministic hash split with an exact per-class threshold:
h = first 32 bits of md5(key|seed); the test set of class c is the
ceil(0.2 * n_c) smallest h. The threshold comes from two histogram passes
(high 16 bits, then low 16 bits) of partial counts, so no task ever sorts or
collects a class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import stored
from .quality import medians_struct, numeric_columns, string_columns, wide_agg


def drop_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the columns that exist (P5); absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def model_frame(df: DataFrame, date_like: list[str] | None = None) -> DataFrame:
    """Drop ids, timestamps and any text column (P5, P8, P9); lower-case."""
    df = lower_names(drop_present(df, C.ID_COLUMNS))
    drop = set(string_columns(df)) | set(date_like or [])
    drop |= {f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))}
    return df.drop(*sorted(drop))


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and null count per column, from one aggregate row."""
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__z{i}") for i, c in enumerate(df.columns)]).first()
    return one["__n"] or 0, {c: one[f"__z{i}"] for i, c in enumerate(df.columns)}


def dense_columns(df: DataFrame, max_share: float = C.MAX_MISSING_SHARE) -> list[str]:
    """Columns with null share <= max (P10); one aggregate row."""
    n, nulls = null_counts(df)
    return [c for c in df.columns if n == 0 or nulls[c] / n <= max_share]


def split_hash(key_cols: list[str], seed: int = C.RANDOM_STATE) -> Column:
    """Unsigned 32-bit bucket from md5(key | seed)."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _kth_threshold(h: DataFrame, label: str, share: float) -> DataFrame:
    """Per class: the k-th smallest h, k = ceil(share * n_c). Returns
    (label, threshold) with one row per class."""
    hi = h.withColumn("hi", F.shiftright("h", 16))
    per_hi = hi.groupBy(label, "hi").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy(label).orderBy("hi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = per_hi.groupBy(label).agg(F.sum("cnt").alias("n"))
    cum = per_hi.withColumn("cum", F.sum("cnt").over(w)).join(totals, label)
    k = F.ceil(F.col("n") * F.lit(share))
    # bucket holding the k-th value, and the rank inside it
    pick = (cum.where((F.col("cum") >= k) & (F.col("cum") - F.col("cnt") < k))
            .select(label, "hi", (k - (F.col("cum") - F.col("cnt"))).alias("r")))
    # ``pick`` has one row per class: AQE broadcasts it from its runtime size.
    inner = hi.join(pick, [label, "hi"], "inner")
    per_lo = (inner.withColumn("lo", F.col("h").bitwiseAND(F.lit(0xFFFF)))
              .groupBy(label, "hi", "r", "lo").agg(F.count(F.lit(1)).alias("cnt")))
    w2 = Window.partitionBy(label).orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum2 = per_lo.withColumn("cum", F.sum("cnt").over(w2))
    return (cum2.where((F.col("cum") >= F.col("r")) & (F.col("cum") - F.col("cnt") < F.col("r")))
            .select(label, (F.shiftleft("hi", 16) + F.col("lo")).alias("threshold")))


def stratified_split(df: DataFrame, key_cols: list[str], label: str = C.TARGET,
                     test_share: float = C.TEST_SHARE, seed: int = C.RANDOM_STATE) -> DataFrame:
    """Adds ``is_test`` (M1): per class, the ceil(share * n_c) rows with the
    smallest hash (all rows tied at the threshold go to test)."""
    h = df.withColumn("h", split_hash(key_cols, seed))
    thr = _kth_threshold(h.select(label, "h"), label, test_share)
    # one entry per class: the rows are projected, not shuffled on the label
    by_class = thr.where(F.col(label).isNotNull()).select(
        F.map_from_entries(F.collect_list(F.struct(label, "threshold"))).alias("m")).scalar()
    out = h.withColumn("_thresholds", by_class)
    at = F.try_element_at(F.col("_thresholds"), F.col(label))
    return out.withColumn("is_test", F.coalesce(F.col("h") <= at, F.lit(False))).drop("_thresholds")


def stratified_folds(df: DataFrame, key_cols: list[str], k: int = C.CV_FOLDS, label: str = C.TARGET,
                     seed: int = C.RANDOM_STATE + 1) -> DataFrame:
    """Adds ``fold`` (M3): per class, rows in order of a key hash are dealt to
    the folds in turn, so a class's fold sizes differ by at most one and a row
    keeps its fold however the frame is partitioned.

    A row's place is the count of the class's smaller hash buckets (a window
    over at most 4,096 bucket totals of a class) plus its place in its bucket,
    so no task sorts a class."""
    h = df.withColumn("_h", split_hash(key_cols, seed)).withColumn("_b", F.shiftright("_h", 20))
    sizes = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(label).alias("_label"), F.col("_b").alias("_bucket"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", *key_cols)) - 1
    ranked = h.withColumn("_place", place).join(offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_b") == F.col("_bucket")))
    return ranked.withColumn("fold", F.pmod(F.col("_off") + F.col("_place"), F.lit(k)).cast("int")).drop(
        "_h", "_b", "_place", "_label", "_bucket", "_off")


def impute(df: DataFrame, fit: DataFrame | None = None, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Numeric nulls -> median of ``fit`` rows (default: ``df``), boolean
    nulls -> false (F19). The label is never imputed. Medians come from one
    scalar subquery, computed once."""
    fit = fit if fit is not None else df
    cols = [c for c in numeric_columns(df) if c != C.TARGET] if cols is None else cols
    bools = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    filled = {b: F.coalesce(F.col(b), F.lit(False)) for b in bools}
    if cols:
        # Bind the subquery once as a column; every feature reads that column.
        df = df.withColumn("_medians", medians_struct(fit, cols, exact))
        m = F.col("_medians")
        filled.update({c: F.coalesce(F.col(c).cast("double"), m[c]) for c in cols})
        return df.withColumns(filled).drop("_medians")
    return df.withColumns(filled)


def scaler_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std per column (A16), one pass. ``scale`` is the
    std, or 1 for a constant column."""
    one = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"__m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"__s{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"), F.col(f"__m{i}").alias("mean"),
                              F.col(f"__s{i}").alias("std")) for i, c in enumerate(cols)])
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn(
        "scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def scale_struct(df: DataFrame, cols: list[str]) -> Column:
    """Scalar subquery: struct of (mean, scale) per column."""
    parts = {}
    for c in cols:
        x = F.col(c).cast("double")
        std = F.stddev_pop(x)
        parts[c] = F.struct(F.avg(x).alias("mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias("scale"))
    return wide_agg(df, parts).select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("s")).scalar()


def apply_scaler(df: DataFrame, cols: list[str], fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / scale with the parameters of ``fit``."""
    df = df.withColumn("_scaler", scale_struct(fit if fit is not None else df, cols))
    s = F.col("_scaler")
    return df.withColumns({c: (F.col(c).cast("double") - s[c]["mean"]) / s[c]["scale"] for c in cols}).drop("_scaler")


def apply_scaler_table(df: DataFrame, scaler: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / scale from a stored scaler table (pos, feature, mean,
    scale), bound once as a struct with a field per feature."""
    fields = [F.max(F.when(F.col("feature") == c, F.struct("mean", "scale"))).alias(c) for c in cols]
    df = df.withColumn("_scaler", scaler.agg(*fields).select(F.struct(*[F.col(f"`{c}`") for c in cols])).scalar())
    p = F.col("_scaler")
    return df.withColumns({c: (F.col(c).cast("double") - p[c]["mean"]) / p[c]["scale"] for c in cols}).drop("_scaler")


def align_features(df: DataFrame, feature_names: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Model column order; missing -> 0, extra dropped (P11) but for ``keep``."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(f) if f in have else F.lit(0).alias(f) for f in feature_names])


def prepare_training(features: DataFrame, key_cols: list[str] | None = None, fit_on: str = "train"):
    """End-to-end preparation (M7): model columns -> drop sparse -> split ->
    impute (medians of training rows by default; ``fit_on='all'`` imputes
    before the split as the original did) -> scale numeric features with
    training-row parameters.

    Returns (frame with the key columns and ``is_test``, feature names, scaled names, scaler
    table). The scaler table (pos, feature, mean, std, scale) is what serving
    applies to new rows.
    """
    key_cols = key_cols or ["user_id", "log_ts"]
    # Written once: every later statistic (null shares, medians, scaler) and
    # the forest read the split rows instead of re-deriving the thresholds.
    split = stored(stratified_split(features, key_cols), "split") if "is_test" not in features.columns else features
    m = model_frame(split.drop("h"))
    n, nulls = null_counts(m.drop("is_test"))
    keys = [k for k in key_cols if k not in m.columns]
    keep = [c for c in m.columns if c != "is_test" and (n == 0 or nulls[c] / n <= C.MAX_MISSING_SHARE)]
    if C.TARGET not in keep:
        raise ValueError(f"target column {C.TARGET} not found")
    m = lower_names(split).select(*keys, *keep, "is_test")
    if n < C.MIN_TRAINING_ROWS:
        raise ValueError(f"insufficient data for training: {n} rows (< {C.MIN_TRAINING_ROWS})")
    feats = [c for c in keep if c != C.TARGET]
    nums = [c for c in numeric_columns(m.select(*keep)) if c != C.TARGET]
    train = m.where(~F.col("is_test"))
    # like the original, only columns that have nulls get a median
    missing = [c for c in nums if nulls[c] > 0]
    imp = impute(m, fit=m if fit_on == "all" else train, cols=missing)
    imp = stored(imp, "imputed")
    train_imp = imp.where(~F.col("is_test"))
    scaler = stored(scaler_fit(train_imp, nums), "scaler")
    return apply_scaler_table(imp, scaler, nums), feats, nums, scaler
