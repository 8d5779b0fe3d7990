"""Queries: runs, models and scoring decisions (T3, A15, F22, M8-M11, M13,
S5, S10, J3, A14, J5, T5, F23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import decisions as D
from ..operators import prepare as P
from ..operators import score as SC
from ..operators.quality import _corr, wide_agg
from . import fixtures as X
from . import sql as S
from .catalog import features, log_table, register, split_rows
from .q_ingest import RUNS_SQL
from .q_quality import MODEL_FEATURES, MODEL_NUMERIC, SCORED_SQL, SPLIT_SQL, _corr_sql, _scale_params

q = S.q
CUT = f"TIMESTAMP '{X.CUTOFF}'"
RAW_COLS_SQL = "[" + ", ".join(f"'{c}'" for c in X.RAW_COLUMNS) + "]"

CAND_SQL = """
SELECT 'rf_' || CAST(day AS VARCHAR) AS model_version, trained_at, CAST(day AS VARCHAR) AS data_version,
  round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0), 6) AS test_f1
FROM (SELECT CAST(log_ts AS DATE) AS day, max(log_ts) AS trained_at,
             count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
             count_if(label = 1 AND prediction = 0) AS fn
      FROM scored GROUP BY 1) d"""

HIST_SQL = f"""
SELECT model_version, trained_at, test_f1, production_f1, production_version, promoted,
       CASE WHEN promoted THEN 'promoted' ELSE 'rejected' END AS status FROM hist_r"""

HIST_R_SQL = f"""
SELECT rn, model_version, trained_at, test_f1, CAST(0.0 AS DOUBLE) AS production_f1, CAST(NULL AS VARCHAR) AS production_version,
       test_f1 - 0.0 > {C.MIN_F1_IMPROVEMENT} AS promoted,
       CASE WHEN test_f1 - 0.0 > {C.MIN_F1_IMPROVEMENT} THEN test_f1 ELSE CAST(0.0 AS DOUBLE) END AS prod,
       CASE WHEN test_f1 - 0.0 > {C.MIN_F1_IMPROVEMENT} THEN model_version END AS prod_version
FROM cand_n WHERE rn = 1
UNION ALL
SELECT c.rn, c.model_version, c.trained_at, c.test_f1, r.prod, r.prod_version,
       c.test_f1 - r.prod > {C.MIN_F1_IMPROVEMENT},
       CASE WHEN c.test_f1 - r.prod > {C.MIN_F1_IMPROVEMENT} THEN c.test_f1 ELSE r.prod END,
       CASE WHEN c.test_f1 - r.prod > {C.MIN_F1_IMPROVEMENT} THEN c.model_version ELSE r.prod_version END
FROM hist_r r JOIN cand_n c ON c.rn = r.rn + 1"""


def _hist_ctes(**more):
    return dict(scored=SCORED_SQL, cand=CAND_SQL,
                cand_n="SELECT *, row_number() OVER (ORDER BY trained_at, model_version, test_f1) AS rn FROM cand",
                hist_r=HIST_R_SQL, hist=HIST_SQL, **more)


def _history(spark, sf_dir):
    return D.promotion_history(X.candidates(log_table(spark, sf_dir)))


@register("promotion_decision", S.with_app_log("SELECT * FROM hist", features=True, recursive=True, **_hist_ctes()))
def promotion_decision(spark, sf_dir):
    return _history(spark, sf_dir)


ACTIVE_SQL = "SELECT model_version, trained_at, test_f1 FROM hist WHERE promoted ORDER BY trained_at DESC LIMIT 1"


@register("active_model", S.with_app_log("SELECT * FROM active", features=True, recursive=True,
                                          **_hist_ctes(active=ACTIVE_SQL)))
def active_model(spark, sf_dir):
    return D.active_model(_history(spark, sf_dir))


@register("latest_run", S.with_app_log(
    "SELECT * FROM runs ORDER BY processed_at DESC LIMIT 1", features=True, runs=RUNS_SQL))
def latest_run(spark, sf_dir):
    return D.latest_run(X.feature_runs(log_table(spark, sf_dir)))


NEW_SINCE_SQL = """
SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) AS merged_records,
       CAST(coalesce(sum(new_record_count), 0) AS BIGINT) AS new_records
FROM runs WHERE processed_at > (SELECT max(trained_at) FROM active) AND domain = 'retail'"""


@register("new_since_training", S.with_app_log("SELECT * FROM news", features=True, recursive=True,
                                                **_hist_ctes(active=ACTIVE_SQL, runs=RUNS_SQL, news=NEW_SINCE_SQL)))
def new_since_training(spark, sf_dir):
    log = log_table(spark, sf_dir)
    trained_at = D.active_model(D.promotion_history(X.candidates(log))).select(F.max("trained_at")).scalar()
    return D.new_since(X.feature_runs(log), trained_at)


@register("retrain_decision", S.with_app_log(f"""
SELECT CASE WHEN t IS NULL THEN true WHEN age > {C.MAX_MODEL_AGE_DAYS} THEN true WHEN news >= {C.MIN_NEW_RECORDS_FOR_TRAINING} THEN true ELSE false END AS should_train,
       CASE WHEN t IS NULL THEN 'no production model' WHEN age > {C.MAX_MODEL_AGE_DAYS} THEN 'model too old'
            WHEN news >= {C.MIN_NEW_RECORDS_FOR_TRAINING} THEN 'enough new records' ELSE 'not required' END AS reason,
       age AS model_age_days, news AS new_records
FROM (SELECT t, CAST(floor(date_diff('second', t, (SELECT max(log_ts) FROM app_log)) / 86400.0) AS BIGINT) AS age,
             (SELECT new_records FROM news) AS news
      FROM (SELECT (SELECT max(trained_at) FROM active) AS t) a) b""",
    features=True, recursive=True, **_hist_ctes(active=ACTIVE_SQL, runs=RUNS_SQL, news=NEW_SINCE_SQL)))
def retrain_decision(spark, sf_dir):
    log = log_table(spark, sf_dir)
    now = log.select(F.max("log_ts")).scalar()
    return D.retrain_decision(X.feature_runs(log), D.promotion_history(X.candidates(log)), now)


@register("reprocess_decision", S.with_app_log(f"""
SELECT CASE WHEN l.processed_at IS NULL THEN 'no previous processing'
            WHEN c.record_count <> l.record_count THEN 'record count changed'
            WHEN c.id_count <> l.id_count THEN 'user count changed'
            WHEN NOT coalesce({RAW_COLS_SQL} = l.columns, false) THEN 'columns changed'
            WHEN age > {C.REPROCESS_AGE_DAYS} THEN 'too old' ELSE 'not required' END AS reason,
       c.record_count, l.record_count AS last_record_count, c.id_count, l.id_count AS last_id_count,
       age AS days_since_processing,
       (CASE WHEN l.processed_at IS NULL THEN 'no previous processing'
            WHEN c.record_count <> l.record_count THEN 'record count changed'
            WHEN c.id_count <> l.id_count THEN 'user count changed'
            WHEN NOT coalesce({RAW_COLS_SQL} = l.columns, false) THEN 'columns changed'
            WHEN age > {C.REPROCESS_AGE_DAYS} THEN 'too old' ELSE 'not required' END) <> 'not required' AS should_process
FROM (SELECT count(*) AS record_count, count(DISTINCT user_id) AS id_count FROM app_log) c
LEFT JOIN (SELECT *, CAST(floor(date_diff('second', processed_at, (SELECT max(log_ts) FROM app_log)) / 86400.0) AS BIGINT) AS age
           FROM (SELECT *, {RAW_COLS_SQL} AS columns FROM runs ORDER BY processed_at DESC LIMIT 1) x) l ON true""",
    features=True, runs=RUNS_SQL))
def reprocess_decision(spark, sf_dir):
    log = log_table(spark, sf_dir)
    now = log.select(F.max("log_ts")).scalar()
    return D.reprocess_decision(log, X.feature_runs_with_columns(log), X.RAW_COLUMNS, now)


HISTORY_SQL = """
SELECT h.model_version, h.trained_at, substr(h.model_version, 4, 10) AS data_version, h.status,
       h.test_f1 AS test_f1_score, r.record_count, r.purchase_rate,
       h.test_f1 - lag(h.test_f1) OVER (ORDER BY h.trained_at) AS f1_change
FROM hist h LEFT JOIN runs r ON substr(h.model_version, 4, 10) = r.processing_version"""


@register("model_history", S.with_app_log(HISTORY_SQL, features=True, recursive=True,
                                           **_hist_ctes(runs=RUNS_SQL)))
def model_history(spark, sf_dir):
    h = _history(spark, sf_dir)
    models = h.select("model_version", "trained_at", F.substring("model_version", 4, 10).alias("data_version"),
                      "status", F.create_map(F.lit("test_f1_score"), F.col("test_f1")).alias("metrics"))
    return D.model_history(models, X.feature_runs(log_table(spark, sf_dir))).orderBy(F.col("trained_at").desc())


@register("metric_trend", S.with_app_log(f"SELECT model_version, trained_at, test_f1_score FROM ({HISTORY_SQL}) h WHERE test_f1_score IS NOT NULL",
                                          features=True, recursive=True, **_hist_ctes(runs=RUNS_SQL)))
def metric_trend(spark, sf_dir):
    """The metric of every model that has it, oldest first."""
    return D.metric_trend(model_history(spark, sf_dir)).select("model_version", "trained_at", "test_f1_score")


# --- scoring -----------------------------------------------------------------------

TO_SCORE_SQL = f"""
SELECT *, CASE WHEN log_ts < {CUT} THEN true WHEN user_id % 2 = 0 THEN false ELSE NULL END AS predicted FROM app_log"""
PENDING_SQL = "SELECT * FROM to_score WHERE NOT (predicted IS NOT DISTINCT FROM true)"
PRED_SQL = """
SELECT f.user_id, f.log_ts, 'pred_' || CAST(CAST(f.log_ts AS DATE) AS VARCHAR) AS prediction_id,
       round(f.purchase_intent / 4.0, 6) AS score,
       CAST(CASE WHEN round(f.purchase_intent / 4.0, 6) >= 0.3 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM feat f JOIN pending p ON f.user_id = p.user_id AND f.log_ts = p.log_ts"""


def _score_ctes(**more):
    return dict(to_score=TO_SCORE_SQL, pending=PENDING_SQL, preds=PRED_SQL, **more)


def _to_score(spark, sf_dir):
    return X.to_score(log_table(spark, sf_dir))


@register("pending_rows", S.with_app_log("SELECT * FROM pending", features=True, **_score_ctes()))
def pending_rows(spark, sf_dir):
    return SC.pending_rows(_to_score(spark, sf_dir))


@register("scoring_run_stats", S.with_app_log(
    "SELECT prediction_id, count(*) AS record_count, round(avg(prediction), 6) AS positive_rate FROM preds GROUP BY 1",
    features=True, **_score_ctes()))
def scoring_run_stats(spark, sf_dir):
    return SC.scoring_run_stats(X.rule_predictions(SC.pending_rows(_to_score(spark, sf_dir))))


# The inbox with rows that share a key: every fifth user's rows twice, every
# seventh user's without a timestamp.
_INBOX_SQL = """SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN NULL ELSE log_ts END AS log_ts) FROM to_score
UNION ALL SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN NULL ELSE log_ts END AS log_ts) FROM to_score WHERE user_id % 5 = 0"""


def _copies(spark, sf_dir):
    ts = _to_score(spark, sf_dir).withColumn("log_ts", F.when(F.col("user_id") % 7 != 0, F.col("log_ts")))
    inbox = ts.unionByName(ts.where("user_id % 5 = 0"))
    cols = [c for c in inbox.columns if c != "predicted"]
    open_ = inbox.where(~F.col("predicted").eqNullSafe(F.lit(True)) & (F.col("user_id") % 10 == 0))
    return inbox, open_.select(SC.row_id(cols).alias("row_id")).distinct()


@register("pending_copies", S.with_app_log("""
SELECT user_id, first_visit_date, log_ts, CAST(open_copies - n_done AS BIGINT) AS copies, CAST(n_done + 1 AS BIGINT) AS first_occurrence FROM (
  SELECT user_id, first_visit_date, log_ts, count(*) AS open_copies, CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS n_done
  FROM inbox WHERE predicted IS DISTINCT FROM true GROUP BY ALL) t
WHERE open_copies > n_done""", features=True, **_score_ctes(inbox=_INBOX_SQL)))
def pending_copies(spark, sf_dir):
    """Distinct rows still to score and how many of their copies are open, where
    one copy of every tenth user's open rows has been scored."""
    inbox, done = _copies(spark, sf_dir)
    return SC.pending_copies(inbox, done).select("user_id", "first_visit_date", "log_ts", "copies", F.col("first_occurrence").cast("long").alias("first_occurrence"))


@register("mark_rows", S.with_app_log("""
SELECT user_id, first_visit_date, log_ts, predicted IS NOT DISTINCT FROM true OR (user_id % 10 = 0 AND k = 1) AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, first_visit_date, log_ts, predicted) AS k FROM inbox) t""",
    features=True, **_score_ctes(inbox=_INBOX_SQL)))
def mark_rows(spark, sf_dir):
    """The same inbox with one of the copies of those rows marked."""
    inbox, done = _copies(spark, sf_dir)
    return SC.mark_rows(inbox, done).select("user_id", "first_visit_date", "log_ts", "predicted")


@register("mark_scored", S.with_app_log("""
SELECT t.* EXCLUDE (predicted),
       coalesce(t.predicted, false) OR EXISTS (SELECT 1 FROM preds p WHERE p.user_id = t.user_id AND p.log_ts = t.log_ts) AS predicted
FROM to_score t""", features=True, **_score_ctes()))
def mark_scored(spark, sf_dir):
    ts = _to_score(spark, sf_dir)
    preds = X.rule_predictions(SC.pending_rows(ts))
    return SC.mark_scored(ts, preds, ["user_id", "log_ts"])


# --- feature influence ---------------------------------------------------------------

# All model features: the numeric ones scaled, the one-hot ones as 0 or 1.
_abs = [f"coalesce(abs({_corr_sql(c)}), 0.0) AS a{i}" for i, c in enumerate(MODEL_FEATURES)]
_tot = " + ".join(f"a{i}" for i in range(len(MODEL_FEATURES)))
_value = {c: f"(CAST({q(c)} AS DOUBLE) - m{i}) / s{i}" for i, c in enumerate(MODEL_NUMERIC)}
INFL_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, log_ts ORDER BY round(abs(influence), 9) DESC, feature) AS rank FROM (" + \
    "\nUNION ALL\n".join(
        f"SELECT user_id, log_ts, '{c}' AS feature, w{i} AS importance, {_value.get(c, f'CAST({q(c)} AS DOUBLE)')} AS value, "
        f"w{i} * ({_value.get(c, f'CAST({q(c)} AS DOUBLE)')}) AS influence FROM split, params, imp"
        for i, c in enumerate(MODEL_FEATURES)) + f") u) r WHERE rank <= {C.TOP_INFLUENCES}"


@register("feature_influence", S.with_app_log(
    "SELECT user_id, log_ts, CAST(rank AS INTEGER) AS rank, feature, round(importance, 6) AS importance, "
    "round(value, 6) AS value, round(influence, 6) AS influence FROM infl",
    features=True, split=SPLIT_SQL, params=f"SELECT {_scale_params} FROM split WHERE NOT is_test",
    corr_row=f"SELECT {', '.join(_abs)} FROM feat",
    imp="SELECT " + ", ".join(f"a{i} / ({_tot}) AS w{i}" for i in range(len(MODEL_FEATURES))) + " FROM corr_row",
    infl=INFL_SQL))
def feature_influence(spark, sf_dir):
    """Influence = importance x value over all model features, top 5 per row.
    Importances are the normalized |correlation| with the label (a model-free
    stand-in that SQL can check); ``score_with_active_model`` hands the same
    operator the forest's own importances."""
    f = features(spark, sf_dir)
    y = F.col(C.TARGET).cast("double")
    absc = wide_agg(f, {c: F.coalesce(F.abs(_corr(F.col(c).cast("double"), y)), F.lit(0.0)) for c in MODEL_FEATURES})
    total = None
    for c in MODEL_FEATURES:
        total = F.col(f"`{c}`") if total is None else total + F.col(f"`{c}`")
    imp = absc.select(F.struct(*[(F.col(f"`{c}`") / total).alias(c) for c in MODEL_FEATURES])).scalar()
    sp = split_rows(spark, sf_dir)
    scaled = P.apply_scaler(sp, MODEL_NUMERIC, fit=sp.where(~F.col("is_test")))
    return SC.feature_influence(scaled, imp, MODEL_FEATURES, ["user_id", "log_ts"]).withColumn(
        "rank", F.col("rank").cast("int"))
