"""Classification metrics over (label, prediction, score) rows.

All are single-pass partial aggregates; ROC AUC uses per-score counts and
prefix sums that are partitioned by score range, never one global window over
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def _cnt(cond) -> F.Column:
    return F.count_if(cond)


def target_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of rows per class."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).select(
        label, "rows", F.round(F.col("rows") / total, 6).alias("share"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_c) (M4), k = number of classes present."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "rows", F.round(total / (k * F.col("rows")), 6).alias("weight"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """tp, fp, fn, tn in one row."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        _cnt((y == 1) & (p == 1)).alias("tp"), _cnt((y == 0) & (p == 1)).alias("fp"),
        _cnt((y == 1) & (p == 0)).alias("fn"), _cnt((y == 0) & (p == 0)).alias("tn"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Long form of the 2x2 matrix, zero-filled (A10)."""
    return confusion_counts(df, label, pred).select(F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, prediction, rows)")).select(
        F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("rows").cast("long"))


def _safe_div(a, b) -> F.Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 of class 1; zero division -> 0."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return c.select(
        F.round(_safe_div(tp + tn, tp + fp + fn + tn), 6).alias("accuracy"),
        F.round(prec, 6).alias("precision"),
        F.round(rec, 6).alias("recall"),
        F.round(_safe_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
    )


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision/recall/f1/support, then accuracy, macro and
    support-weighted averages (A12). Built from the one-row confusion
    counts, so the whole report costs one pass."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    # class 1: (tp, fp, fn); class 0 mirrors: (tn, fn, fp)
    def per_class(t, f_p, f_n):
        p = _safe_div(t, t + f_p)
        r = _safe_div(t, t + f_n)
        f1 = _safe_div(2 * t, 2 * t + f_p + f_n)
        return p, r, f1, t + f_n

    p0, r0, f0, s0 = per_class(tn, fn, fp)
    p1, r1, f1, s1 = per_class(tp, fp, fn)
    n = s0 + s1
    rows = c.select(F.explode(F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _safe_div(tp + tn, n).alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _safe_div(p0 * s0 + p1 * s1, n).alias("precision"),
                 _safe_div(r0 * s0 + r1 * s1, n).alias("recall"), _safe_div(f0 * s0 + f1 * s1, n).alias("f1"),
                 n.alias("support")),
    )).alias("r")).select("r.*")
    return rows.select("class", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")],
                       F.col("support").cast("long").alias("support"))


def weighted_f1(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Support-weighted F1 (the cross-validation score)."""
    return class_report(df, label, pred).where(F.col("class") == "weighted avg").select(F.col("f1").alias("weighted_f1"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC with ties counted one half (the rank-sum statistic).

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).
    neg(< s) is a distributed prefix sum over distinct scores: they are dealt to
    range partitions by sampled splitters, so an outlier or a crowded part of the
    range fills no partition beyond its share; each partition sums its own scores
    in order, and the partitions' totals (one row each) give their offsets. The
    partitions are written once, as a second sample would split elsewhere. Rows
    without a score or a label rank nowhere and do not count; NaN ranks above
    every other score.
    """
    df = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    y = F.col(label)
    per_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        _cnt(y == 1).cast("double").alias("pos"), _cnt(y == 0).cast("double").alias("neg"))
    placed = stored(per_score.repartitionByRange("s").withColumn("b", F.spark_partition_id()), "scores")
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("b").agg(F.sum("neg").alias("bneg")).select("b", F.coalesce(F.sum("bneg").over(before), F.lit(0.0)).alias("off"))
    within = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("local_below", F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
    terms = local.join(offsets, "b").select((F.col("pos") * (F.col("off") + F.col("local_below") + F.col("neg") / 2)).alias("t"), "pos", "neg")
    agg = terms.agg(F.sum("t").alias("t"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(F.round(F.try_divide(F.col("t"), F.col("p") * F.col("n")), 6).alias("roc_auc"))
