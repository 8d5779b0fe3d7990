"""Scenario inputs derived by Spark from the shared tables (FIXTURES.md §1,
§3, §4). Everything here grows with the data it is derived from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.featurize import featurize
from ..operators.ingest import with_record_hash

# Fixed values of the incremental scenario.
CUTOFF = "2024-01-20 00:00:00"
SCORE_DIVISOR = 4.0
SCORE_THRESHOLD = 0.3
DOMAIN = "retail"


def cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def existing_log(log: DataFrame) -> DataFrame:
    """Rows featurized by an earlier run."""
    return log.where((F.col("log_ts") < cutoff()) & (F.col("user_id") % 3 != 0))


def new_log(log: DataFrame) -> DataFrame:
    """Rows arriving after the cutoff."""
    return log.where(F.col("log_ts") >= cutoff())


def stored_log(log: DataFrame) -> DataFrame:
    """Rows whose hashes are already stored before the ingest run."""
    return with_record_hash(log.where((F.col("log_ts") < cutoff()) | (F.col("user_id") % 5 == 0)))


def scored(log: DataFrame) -> DataFrame:
    """Rule-scored feature rows: score = round(intent / 4, 6), predicted
    class = score >= 0.3, label = purchase_24h."""
    f = featurize(log, C.FIXTURE_VOCABULARY)
    score = F.round(F.col("purchase_intent") / F.lit(SCORE_DIVISOR), 6)
    return f.select(
        "user_id", "log_ts", F.col("purchase_24h").alias("label"), score.alias("score"),
        F.when(score >= F.lit(SCORE_THRESHOLD), 1).otherwise(0).cast("int").alias("prediction"),
    )


def feature_runs(log: DataFrame) -> DataFrame:
    """One run per day of ``log_ts``; record_count is the running total.

    The running total is a window over the per-day aggregate (one row per
    day, not per record).
    """
    f = featurize(log, C.FIXTURE_VOCABULARY).withColumn("day", F.to_date("log_ts"))
    per_day = f.groupBy("day").agg(
        F.max("log_ts").alias("processed_at"),
        F.count(F.lit(1)).alias("new_record_count"),
        F.count_distinct("user_id").alias("id_count"),
        F.avg("purchase_24h").alias("purchase_rate"),
    )
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select(
        F.col("day").cast("string").alias("processing_version"),
        "processed_at",
        F.sum("new_record_count").over(upto).alias("record_count"),
        "new_record_count", "id_count",
        F.round("purchase_rate", 6).alias("purchase_rate"),
        F.lit(DOMAIN).alias("domain"),
    )


RAW_COLUMNS = sorted(["user_id", "first_visit_date", "purchase_date", "screen_list", "session_count",
                      "total_screens_viewed", "used_search_feature", "wrote_review", "added_to_wishlist", "age",
                      "platform", "region", "acquisition_channel", "user_segment", "app_version", "made_purchase",
                      "log_ts"])


def feature_runs_with_columns(log: DataFrame) -> DataFrame:
    """Run table with the sorted source column list of each run."""
    return feature_runs(log).withColumn("columns", F.array(*[F.lit(c) for c in RAW_COLUMNS]))


def candidates(log: DataFrame) -> DataFrame:
    """One candidate model per day of data: its test F1 is the rule scorer's
    F1 on that day's rows (derived, so it grows with the data)."""
    s = scored(log).withColumn("day", F.to_date("log_ts"))
    y, p = F.col("label"), F.col("prediction")
    g = s.groupBy("day").agg(
        F.max("log_ts").alias("trained_at"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"))
    f1 = F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"),
                                 (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    return g.select(F.concat(F.lit("rf_"), F.col("day").cast("string")).alias("model_version"), "trained_at",
                    F.col("day").cast("string").alias("data_version"), F.round(f1, 6).alias("test_f1"))


def to_score(log: DataFrame) -> DataFrame:
    """Scoring inbox: raw rows with a tri-state ``predicted`` flag."""
    flag = (F.when(F.col("log_ts") < cutoff(), F.lit(True))
            .when(F.col("user_id") % 2 == 0, F.lit(False)).otherwise(F.lit(None).cast("boolean")))
    return log.withColumn("predicted", flag)


def rule_predictions(pending: DataFrame) -> DataFrame:
    """Rule-scored pending rows, one scoring run per arrival day."""
    f = featurize(pending, C.FIXTURE_VOCABULARY, mode="serve")
    score = F.round(F.col("purchase_intent") / F.lit(SCORE_DIVISOR), 6)
    return f.select("user_id", "log_ts",
                    F.concat(F.lit("pred_"), F.to_date("log_ts").cast("string")).alias("prediction_id"),
                    score.alias("score"),
                    F.when(score >= F.lit(SCORE_THRESHOLD), 1).otherwise(0).cast("int").alias("prediction"))
