"""Registered queries: one Spark plan per operator, each with its DuckDB
oracle (or none, for operators checked by invariants in pytest).

Every query reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions.categorical import one_hot_name
from ..functions.hashing import record_hash
from ..functions.screens import flag_name
from ..operators.featurize import featurize
from ..operators.prepare import stratified_split as stratified
from ..sources.tables import app_log
from ..session import session_key, stored
from . import sql as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# Stores written once per session and input folder, like the original's raw
# collection and feature table: later queries read the written data instead
# of re-deriving it from events on every action (and a lost executor re-reads
# files rather than recomputing the lineage). Parquet under
# ``spark.checkpoint.dir`` (shared storage on a cluster), so every query reads
# only its columns. The input's files are part of the key: a file added under
# ``sf_dir`` makes a new store.
_STORES: dict[tuple, DataFrame] = {}


def input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of a session and of the files that the app log is derived from."""
    files = tuple(sorted(f for t in ("events", "customer") for f in spark.read.parquet(f"{sf_dir}/{t}.parquet").inputFiles()))
    return (*session_key(spark), sf_dir, files)


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (*input_key(spark, sf_dir), name)
    df = _STORES.get(key)
    if df is None:
        df = _STORES[key] = stored(build(), name)
    return df


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw app-log store (derived from events once per session)."""
    return _stored(spark, sf_dir, "app_log", lambda: app_log(spark, sf_dir))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with its train / test split, shared by its users."""
    return _stored(spark, sf_dir, "split", lambda: stratified(features(spark, sf_dir), ["user_id", "log_ts"]))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written feature table (featurized once per session), from the
    mergeable state of the screens: no list of events is gathered or joined."""
    return _stored(spark, sf_dir, "features", lambda: featurize(app_log(spark, sf_dir, lists=False), C.FIXTURE_VOCABULARY))


KEY = ["user_id", "log_ts"]
FLAGS = [flag_name(s) for s in C.TRACKED_SCREENS]
ONE_HOT = [one_hot_name(C.ONE_HOT_PREFIX[src], v) for src in C.ONE_HOT_PREFIX for v in C.FIXTURE_VOCABULARY[src]]


def _feature_subset(name: str, cols: list[str]) -> None:
    sel_sql = ", ".join(S.q(c) for c in KEY + cols)

    @register(name, S.with_app_log(f"SELECT {sel_sql} FROM feat", features=True))
    def _q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return featurize(log_table(spark, sf_dir), C.FIXTURE_VOCABULARY).select(*KEY, *cols)


# --- 2.1 scans ---------------------------------------------------------------


@register("scan_raw_log", S.with_app_log("SELECT * FROM app_log"))
def scan_raw_log(spark, sf_dir):
    return app_log(spark, sf_dir)


@register("purchase_rate_by_region", S.with_app_log(f"""
SELECT region, count(*) AS visits, count(DISTINCT user_id) AS users, CAST(sum(purchase_24h) AS BIGINT) AS purchases,
       round(avg(purchase_24h), 6) AS purchase_rate
FROM (SELECT region, user_id,
        CASE WHEN date_diff('microsecond', {S.parse_date_sql('first_visit_date')}, {S.parse_date_sql('purchase_date')}) / 3.6e9 <= 24.0
             THEN 1 ELSE 0 END AS purchase_24h
      FROM app_log) t
GROUP BY region"""))
def purchase_rate_by_region(spark, sf_dir):
    log = app_log(spark, sf_dir, lists=False)
    lab = log.select(
        "region", "user_id",
        dates.purchase_label(dates.parse_date("first_visit_date"), dates.parse_date("purchase_date")).alias("purchase_24h"))
    return lab.groupBy("region").agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_distinct("user_id").alias("users"),
        F.sum("purchase_24h").cast("long").alias("purchases"),
        F.round(F.avg("purchase_24h"), 6).alias("purchase_rate"),
    )


# --- 2.7 scalar functions ------------------------------------------------------


@register("record_hash", S.with_app_log(f"""
SELECT user_id, first_visit_date,
  md5(concat_ws('|', coalesce(trim(CAST(user_id AS VARCHAR)), 'nan'),
     coalesce(strftime({S.parse_date_sql('first_visit_date')}, '%Y-%m-%d'), trim(first_visit_date), 'nan'))) AS record_hash
FROM app_log"""))
def record_hash_q(spark, sf_dir):
    return log_table(spark, sf_dir).select("user_id", "first_visit_date", record_hash().alias("record_hash"))


@register("parse_dates", S.with_app_log(f"""
SELECT user_id, log_ts, {S.parse_date_sql('first_visit_date')} AS first_visit_ts,
       {S.parse_date_sql('purchase_date')} AS purchase_ts
FROM app_log"""))
def parse_dates_q(spark, sf_dir):
    return log_table(spark, sf_dir).select(
        *KEY, dates.parse_date("first_visit_date").alias("first_visit_ts"),
        dates.parse_date("purchase_date").alias("purchase_ts"))


# Date texts of real exports, derived from first_visit_date by user: (Spark, DuckDB) forms.
_DATE_FORMS = [("M/d/yyyy", "%-m/%-d/%Y"), ("MM/dd/yyyy HH:mm", "%m/%d/%Y %H:%M"), ("yyyy/M/d", "%Y/%-m/%-d"), ("MMM d, yyyy", "%b %-d, %Y"),
               ("yyyyMMdd", "%Y%m%d"), ("d MMM yyyy", "%-d %b %Y"), ("MMMM d, yyyy H:m:s", "%B %-d, %Y %-H:%-M:%-S"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S")]
_FORM_SQL = "CASE user_id % 8 " + " ".join(
    f"WHEN {i} THEN strftime({S.parse_date_sql('first_visit_date')}, '{duck}')" for i, (_, duck) in enumerate(_DATE_FORMS)) + " END"


@register("date_formats", S.with_app_log(f"""
SELECT user_id, log_ts, date_text, {S.parse_date_sql('date_text')} AS parsed,
  md5(concat_ws('|', CAST(user_id AS VARCHAR), strftime({S.parse_date_sql('date_text')}, '%Y-%m-%d'))) AS record_hash
FROM (SELECT user_id, log_ts, chr(9) || {_FORM_SQL} || ' ' AS date_text FROM app_log) t"""))
def date_formats_q(spark, sf_dir):
    """Parsed date and record hash of every text form that exports use."""
    day = dates.parse_date("first_visit_date")
    text = F.coalesce(*[F.when(F.col("user_id") % 8 == i, F.date_format(day, form)) for i, (form, _) in enumerate(_DATE_FORMS)])
    rows = log_table(spark, sf_dir).select(*KEY, F.concat(F.lit("\t"), text, F.lit(" ")).alias("first_visit_date"))
    return rows.select(*KEY, F.col("first_visit_date").alias("date_text"), dates.parse_date("first_visit_date").alias("parsed"),
                       record_hash(["user_id", "first_visit_date"]).alias("record_hash"))


@register("purchase_label", S.with_app_log(f"""
SELECT user_id, log_ts,
  round(date_diff('microsecond', {S.parse_date_sql('first_visit_date')}, {S.parse_date_sql('purchase_date')}) / 3.6e9, 6) AS hours_to_purchase,
  purchase_24h
FROM (SELECT *, CAST(CASE WHEN date_diff('microsecond', {S.parse_date_sql('first_visit_date')}, {S.parse_date_sql('purchase_date')}) / 3.6e9 <= 24.0
                 THEN 1 ELSE 0 END AS INTEGER) AS purchase_24h FROM app_log) t"""))
def purchase_label_q(spark, sf_dir):
    fv, pd_ = dates.parse_date("first_visit_date"), dates.parse_date("purchase_date")
    return log_table(spark, sf_dir).select(
        *KEY, F.round(dates.hours_between(fv, pd_), 6).alias("hours_to_purchase"),
        dates.purchase_label(fv, pd_).alias("purchase_24h"))


_feature_subset("time_features", ["hour", "dayofweek", "is_weekend"])
_feature_subset("screen_flags", FLAGS)
_feature_subset("screen_counts", list(C.SCREEN_CATEGORIES))
_feature_subset("other_screens", ["other_screens"])
_feature_subset("behavior_scores", ["engagement_score", "screen_diversity", "purchase_intent"])
_feature_subset("platform_code", ["platform"])
_feature_subset("version_features", ["app_major_version", "version_score"])
_feature_subset("one_hot", ONE_HOT)


@register("segment_parts", S.with_app_log("""
SELECT user_id, log_ts,
  list_filter(regexp_split_to_array(user_segment, '\\s+'), lambda x: x <> '')[1] AS age_group,
  array_to_string(list_filter(regexp_split_to_array(user_segment, '\\s+'), lambda x: x <> '')[2:], ' ') AS user_type
FROM app_log"""))
def segment_parts_q(spark, sf_dir):
    from ..functions.categorical import age_group, user_type

    return log_table(spark, sf_dir).select(*KEY, age_group("user_segment").alias("age_group"),
                                         user_type("user_segment").alias("user_type"))


@register("features", S.with_app_log("SELECT * FROM feat", features=True))
def features_q(spark, sf_dir):
    return featurize(app_log(spark, sf_dir, lists=False), C.FIXTURE_VOCABULARY)


# Register the remaining query groups (they import ``register`` from here).
from . import q_decisions, q_ingest, q_model, q_quality  # noqa: E402,F401
