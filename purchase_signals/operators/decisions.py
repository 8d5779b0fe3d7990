"""Run and model decisions.

Run and model tables hold one row per run (not per record). Decisions are
one-row DataFrames built from aggregates over those tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import whole_days_between
from ..session import stored


def latest_run(runs: DataFrame, order_col: str = "processed_at") -> DataFrame:
    """The latest run row (T3): ``max_by`` over a struct, no sort."""
    return runs.select(F.max_by(F.struct(*runs.columns), F.col(order_col)).alias("r")).select("r.*")


@dataclass(frozen=True)
class Production:
    """The model in production and the score it was promoted with; the baseline
    is 0 before the first promotion."""
    score: float = 0.0
    model_version: str | None = None
    trained_at: dt.datetime | None = None


def promotions(candidates: DataFrame, min_gain: float = C.MIN_F1_IMPROVEMENT, since: Production | None = None) -> list[Production]:
    """The promotions among the candidates behind ``since``, in order (M8, M9).

    Production changes only on promotion, so the next one is the earliest
    candidate behind the last whose F1 exceeds its score by more than
    ``min_gain`` (strict): one aggregate, combined map-side. An F1 is at most 1
    and every promotion adds more than ``min_gain``, so there are fewer than
    1 / min_gain + 1 of them, however many candidates. A null or NaN F1 promotes
    nothing. Repeated rows count once."""
    state, found = since or Production(), []
    item = F.struct("trained_at", "model_version", "test_f1")
    fair = candidates.where(~F.isnan("test_f1"))
    while True:
        better = fair.where(F.col("test_f1") - F.lit(state.score) > F.lit(min_gain))
        if state.model_version is not None:
            better = better.where(_behind(state))
        best = better.agg(F.min(item).alias("r")).first().r
        if best is None:
            return found
        state = Production(best.test_f1, best.model_version, best.trained_at)
        found.append(state)


def _behind(p: Production) -> Column:
    """Candidates in order behind the one that was promoted as ``p``."""
    at = F.lit(p.trained_at).cast("timestamp_ntz")
    return (F.col("trained_at") > at) | ((F.col("trained_at") == at) & (F.struct("model_version", "test_f1") > F.struct(
        F.lit(p.model_version).alias("model_version"), F.lit(p.score).alias("test_f1"))))


def promotion_history(candidates: DataFrame, min_gain: float = C.MIN_F1_IMPROVEMENT, since: Production | None = None) -> DataFrame:
    """Every candidate with the production model that it met and the decision
    (M8, M9); with ``since``, of the candidates behind that promotion alone.

    The promotions are found first (a pass each, a bounded number); what was in
    production before a candidate is then a projection over them. No candidate is
    gathered or sorted. Candidates without ``trained_at`` are left out."""
    candidates = stored(candidates.where(F.col("trained_at").isNotNull()), "candidates")
    if since is not None and since.model_version is not None:
        candidates = candidates.where(_behind(since))
    start = since or Production()
    met = [(F.lit(True), start)] + [(_behind(p), p) for p in promotions(candidates, min_gain, since)]
    score, version = (F.coalesce(*[F.when(c, F.lit(v(p))) for c, p in reversed(met) if v(p) is not None], F.lit(None).cast(kind))
                      for v, kind in ((lambda p: p.score, "double"), (lambda p: p.model_version, "string")))
    better = (F.col("test_f1") - F.col("production_f1") > F.lit(min_gain)) & ~F.isnan("test_f1")
    return candidates.select("model_version", "trained_at", "test_f1", score.alias("production_f1"), version.alias("production_version")) \
        .withColumn("promoted", better) \
        .withColumn("status", F.when(F.col("promoted"), F.lit("promoted")).otherwise(F.lit("rejected")))


def active_model(history: DataFrame) -> DataFrame:
    """The model in production: the latest promoted one."""
    promoted = history.where(F.col("promoted"))
    return promoted.select(F.max_by(F.struct("model_version", "trained_at", "test_f1"), F.col("trained_at")).alias("m")) \
        .select("m.*")


def new_since(runs: DataFrame, since: Column, domain: str = "retail") -> DataFrame:
    """Records processed after ``since`` (A15): both the original's sum of
    merged sizes and the sum of truly new records."""
    r = runs.where((F.col("processed_at") > since) & (F.col("domain") == F.lit(domain)))
    return r.agg(F.coalesce(F.sum("record_count"), F.lit(0)).cast("long").alias("merged_records"),
                 F.coalesce(F.sum("new_record_count"), F.lit(0)).cast("long").alias("new_records"))


def retrain_decision(runs: DataFrame, history: DataFrame, now: Column,
                     max_age_days: int = C.MAX_MODEL_AGE_DAYS,
                     min_new: int = C.MIN_NEW_RECORDS_FOR_TRAINING) -> DataFrame:
    """Retrain? In order (M10): no production model -> yes; older than
    ``max_age_days`` -> yes; at least ``min_new`` new records -> yes; else
    no. Counts only truly new records (not merged sizes)."""
    prod = active_model(history)
    trained_at = prod.select(F.max("trained_at")).scalar()
    news = new_since(runs, trained_at).select(F.max("new_records")).scalar()
    age = whole_days_between(trained_at, now)
    spark = runs.sparkSession
    return spark.range(1).select(
        F.when(trained_at.isNull(), F.lit(True)).when(age > max_age_days, F.lit(True))
         .when(news >= min_new, F.lit(True)).otherwise(F.lit(False)).alias("should_train"),
        F.when(trained_at.isNull(), F.lit("no production model"))
         .when(age > max_age_days, F.lit("model too old"))
         .when(news >= min_new, F.lit("enough new records"))
         .otherwise(F.lit("not required")).alias("reason"),
        age.alias("model_age_days"),
        news.alias("new_records"),
    )


def reprocess_decision(current: DataFrame, runs: DataFrame, columns: list[str], now: Column,
                       max_age_days: int = C.REPROCESS_AGE_DAYS) -> DataFrame:
    """Reprocess? In order (M11): no earlier run; record count changed; user
    count changed; columns changed (compared sorted); last run older than
    ``max_age_days``; else no."""
    last = runs.select(F.max_by(F.struct("record_count", "id_count", "columns", "processed_at"),
                                F.col("processed_at"))).scalar()
    cur = current.agg(F.count(F.lit(1)).alias("record_count"), F.count_distinct("user_id").alias("id_count"))
    cur_cols = F.array(*[F.lit(c) for c in sorted(columns)])
    age = whole_days_between(last["processed_at"], now)
    return cur.select(
        F.when(last["processed_at"].isNull(), F.lit("no previous processing"))
         .when(F.col("record_count") != last["record_count"], F.lit("record count changed"))
         .when(F.col("id_count") != last["id_count"], F.lit("user count changed"))
         .when(~F.coalesce(cur_cols == last["columns"], F.lit(False)), F.lit("columns changed"))
         .when(age > max_age_days, F.lit("too old"))
         .otherwise(F.lit("not required")).alias("reason"),
        "record_count", last["record_count"].alias("last_record_count"),
        "id_count", last["id_count"].alias("last_id_count"), age.alias("days_since_processing"),
    ).withColumn("should_process", F.col("reason") != F.lit("not required"))


def previous(df: DataFrame, order: str, value: str) -> tuple[DataFrame, Column]:
    """The rows, range-partitioned by ``order`` and written once, and a column for
    ``value`` of the row before (null for the first). A partition's first row takes
    the last of the partition before; only those ends, one row for each partition,
    meet in one task."""
    placed = stored(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ordered")
    one = F.struct(F.col(value).alias("v"))
    ends = placed.groupBy("_part").agg(F.max_by(one, F.struct(order)).alias("end"))
    carried = ends.select("_part", F.lag("end").over(Window.orderBy("_part")).alias("_carried"))
    rows = placed.join(carried, "_part")
    return rows, F.coalesce(F.lag(one).over(Window.partitionBy("_part").orderBy(order)), F.col("_carried"))["v"]


def model_history(models: DataFrame, runs: DataFrame) -> DataFrame:
    """Model rows with their data run (J4), F1 read from the metrics map
    (F24, null if absent) and the change against the previous model (T4)."""
    j = models.join(runs.select(F.col("processing_version").alias("data_version"), "record_count", "purchase_rate"),
                    "data_version", "left")
    f1 = F.try_element_at(F.col("metrics"), F.lit("test_f1_score"))
    rows, before = previous(j.withColumn("test_f1_score", f1), "trained_at", "test_f1_score")
    return rows.select("model_version", "trained_at", "data_version", "status", "test_f1_score", "record_count", "purchase_rate",
                       (F.col("test_f1_score") - before).alias("f1_change"))


def metric_trend(history: DataFrame, metric: str = "test_f1_score") -> DataFrame:
    """Oldest first, rows without the metric dropped."""
    return history.na.drop(subset=[metric]).orderBy("trained_at")
