"""Scoring side: pending rows, scored marks, row identity, run stats, influence
(S5, S10, J3, A14, J5, T5, F23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C


def pending_rows(to_score: DataFrame, flag: str = "predicted") -> DataFrame:
    """Rows not yet scored (S5): flag is not true (null counts as pending)."""
    return to_score.where(~F.col(flag).eqNullSafe(F.lit(True)))


def mark_scored(to_score: DataFrame, predictions: DataFrame, key: list[str], flag: str = "predicted") -> DataFrame:
    """Recompute the scored flag (S10, J3): true when already true or when
    the key has a prediction. A left join against the distinct predicted keys
    (map-side distinct, then one shuffle on the key) instead of in-place
    updates; a null in a key equals a null."""
    done = predictions.select(*[F.col(k).alias(f"_done_{k}") for k in key]).distinct().withColumn("_scored", F.lit(True))
    same = [to_score[k].eqNullSafe(done[f"_done_{k}"]) for k in key]
    j = to_score.join(done, same, "left")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(F.col("_scored"), F.lit(False))) \
        .select(*to_score.columns)


def row_id(cols: list[str]) -> Column:
    """Identity of a row by all its values, nulls included: 32 hex digits."""
    text = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
            for c in sorted(cols)]
    return F.md5(F.concat_ws("|", *text))


def _copies(to_score: DataFrame, done: DataFrame, flag: str) -> DataFrame:
    """(row_id, marked, open, n_done): copies of each row in ``to_score`` with and
    without the flag, and its stored predictions. Counts are combined map-side."""
    marked = F.col(flag).eqNullSafe(F.lit(True))
    counts = to_score.groupBy("row_id").agg(F.count_if(marked).alias("marked"), F.count_if(~marked).alias("open"))
    scored = done.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_done"))
    # predictions beyond the marked copies belong to copies that are not marked yet
    return counts.join(scored, "row_id", "left").withColumn("n_done", F.coalesce("n_done", F.lit(0))).withColumn(
        "late", F.least("open", F.greatest(F.lit(0), F.col("n_done") - F.col("marked"))))


def pending_copies(to_score: DataFrame, done: DataFrame, flag: str = "predicted") -> DataFrame:
    """Rows still to score (S5, S10), one for each distinct row, with ``row_id``,
    ``copies`` (how many of its copies are open) and ``first_occurrence`` (the
    number the first of them gets).

    A row is identified by all its values and the number of its occurrence, so
    rows with equal or null keys are rows of their own. ``done`` has the
    ``row_id`` of every stored prediction."""
    cols = [c for c in to_score.columns if c != flag]
    rows = to_score.withColumn("row_id", row_id(cols))
    left = _copies(rows, done, flag).where("open > late")
    one = rows.groupBy("row_id").agg(F.any_value(F.struct(*cols)).alias("r"))
    return one.join(left, "row_id").select(
        *[F.col(f"r.`{c}`").alias(c) for c in cols], "row_id", (F.col("open") - F.col("late")).alias("copies"),
        (F.greatest("marked", "n_done") + 1).alias("first_occurrence"))


def occurrences(scored: DataFrame) -> DataFrame:
    """One row for each pending copy, with its ``occurrence``."""
    last = F.col("first_occurrence") + F.col("copies") - 1
    return scored.withColumn("occurrence", F.explode(F.sequence("first_occurrence", last))).drop("copies", "first_occurrence")


def mark_rows(to_score: DataFrame, done: DataFrame, flag: str = "predicted") -> DataFrame:
    """``to_score`` with the flag recomputed by row identity: as many copies of a
    row are true as it has predictions (marked ones first). Only rows of which
    some copies are scored and some are not need a number among their copies."""
    cols = [c for c in to_score.columns if c != flag]
    rows = to_score.withColumn("row_id", row_id(cols))
    j = rows.join(_copies(rows, done, flag).select("row_id", "open", "late"), "row_id")
    marked = F.coalesce(F.col(flag), F.lit(False))
    part = (F.col("late") > 0) & (F.col("late") < F.col("open"))
    whole = j.where(~part | marked).withColumn(flag, marked | (F.col("late") > 0))
    number = F.row_number().over(Window.partitionBy("row_id").orderBy("late"))
    some = j.where(part & ~marked).withColumn(flag, number <= F.col("late"))
    return whole.unionByName(some).select(*to_score.columns)


def scoring_run_stats(predictions: DataFrame, run_col: str = "prediction_id", pred: str = "prediction") -> DataFrame:
    """Per scoring run: record count and positive rate."""
    return predictions.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("record_count"), F.round(F.avg(pred), 6).alias("positive_rate"))


def feature_influence(values: DataFrame, importances: Column, features: list[str], key: list[str],
                      top: int | None = C.TOP_INFLUENCES) -> DataFrame:
    """Per row, the ``top`` features by |importance x value| (J5, T5, F23), all
    of them for ``top=None``.

    ``importances`` is a struct column (one field per feature), e.g. a
    scalar subquery over a one-row table. The ranking is a per-row sort of
    (-|influence| to nine digits, place of the name) pairs, plain numbers only (a
    decimal rounding of every value would cost more than the sort); name, importance and
    value are looked up for the few that are kept: no shuffle, no window over
    rows, no lambda. Null influences rank last, ties go by name."""
    names = sorted(features)
    values = values.withColumn("_imp", importances)
    values = values.select(*key, F.array(*[F.coalesce(F.col("_imp")[f], F.lit(0.0)) for f in names]).alias("_w"),
                           F.array(*[F.col(f"`{f}`").cast("double") for f in names]).alias("_v"))
    ranks = F.array(*[F.struct(F.coalesce(-F.rint(F.abs(F.col("_w")[i] * F.col("_v")[i]) * F.lit(1e9)), F.lit(1.0)).alias("k"), F.lit(i).alias("i"))
                      for i in range(len(names))])
    topk = F.slice(F.sort_array(ranks), 1, top or len(names))
    rows = values.select(*key, "_w", "_v", F.posexplode(topk.getField("i")).alias("pos", "i"))
    w, v = F.col("_w")[F.col("i")], F.col("_v")[F.col("i")]
    return rows.select(*key, (F.col("pos") + 1).alias("rank"), F.element_at(F.lit(names), F.col("i") + 1).alias("feature"),
                       F.round(w, 6).alias("importance"), F.round(v, 6).alias("value"), F.round(w * v, 6).alias("influence"))
