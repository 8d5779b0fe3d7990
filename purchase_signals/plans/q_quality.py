"""Queries: quality, statistics, metrics and training preparation (A4-A13,
A16, A19, T1, P5, P7-P11, F19, F20, M1, M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import metrics as MX
from ..operators import prepare as P
from ..operators import quality as Q
from ..operators.featurize import feature_columns, featurize
from ..operators.vocab import fit_vocabulary
from . import fixtures as X
from . import sql as S
from .catalog import features, log_table, register, split_rows

PASSTHROUGH = ["user_id", "session_count", "total_screens_viewed", "used_search_feature", "wrote_review",
               "added_to_wishlist", "age", "platform", "log_ts"]
FEATURE_TABLE = PASSTHROUGH + [C.TARGET] + feature_columns(C.FIXTURE_VOCABULARY)
ONE_HOT = set(feature_columns(C.FIXTURE_VOCABULARY)) - set(feature_columns({}))
NUMERIC = [c for c in FEATURE_TABLE if c not in ONE_HOT and c != "log_ts"]
MODEL_NUMERIC = [c for c in NUMERIC if c not in (C.TARGET, "user_id")]
RAW_COLUMNS = ["user_id", "first_visit_date", "purchase_date", "screen_list", "session_count", "total_screens_viewed",
               "used_search_feature", "wrote_review", "added_to_wishlist", "age", "platform", "region",
               "acquisition_channel", "user_segment", "app_version", "made_purchase", "log_ts"]
RAW_STRINGS = ["first_visit_date", "purchase_date", "screen_list", "platform", "region", "acquisition_channel",
               "user_segment", "app_version"]

q = S.q


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- quality ---------------------------------------------------------------------

_any_null = " OR ".join(f"{q(c)} IS NULL" for c in FEATURE_TABLE)
NULL_SQL = "SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS column_name, count_if({q(c)} IS NULL) AS null_count, "
     f"round(CAST(count_if({q(c)} IS NULL) AS DOUBLE) * 100.0 / count(*), 6) AS null_pct FROM feat" for c in FEATURE_TABLE]
    + [f"SELECT '*' AS column_name, count_if({_any_null}) AS null_count, "
       f"round(CAST(count_if({_any_null}) AS DOUBLE) * 100.0 / count(*), 6) AS null_pct FROM feat"]) + ") t WHERE null_count > 0"


@register("null_report", S.with_app_log(NULL_SQL, features=True))
def null_report(spark, sf_dir):
    return Q.null_report(features(spark, sf_dir))


@register("sparse_columns", S.with_app_log(_union(
    [f"SELECT '{c}' AS column_name, round(CAST(count_if({c} IS NULL) AS DOUBLE) / count(*), 6) AS null_share, "
     f"CAST(count_if({c} IS NULL) AS DOUBLE) / count(*) > {C.MAX_MISSING_SHARE} AS dropped FROM app_log" for c in RAW_COLUMNS])))
def sparse_columns(spark, sf_dir):
    return Q.sparse_columns(log_table(spark, sf_dir))


@register("date_like_columns", S.with_app_log(_union(
    [f"SELECT '{c}' AS column_name, coalesce(bool_or(regexp_matches({c}, '{C.DATE_LIKE_PATTERN}')), false) AS date_like "
     f"FROM app_log" for c in RAW_STRINGS])))
def date_like_columns(spark, sf_dir):
    return Q.date_like_columns(log_table(spark, sf_dir))


def _corr_sql(c: str) -> str:
    x, y = f"CAST({q(c)} AS DOUBLE)", f"CAST(CASE WHEN {q(c)} IS NOT NULL THEN purchase_24h END AS DOUBLE)"
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


@register("label_correlation", S.with_app_log(
    "SELECT feature, correlation FROM (" + _union(
        [f"SELECT '{c}' AS feature, round({_corr_sql(c)}, 6) AS correlation FROM feat" for c in NUMERIC])
    + f") t ORDER BY correlation DESC NULLS LAST, feature LIMIT {C.TOP_CORRELATIONS}", features=True))
def label_correlation(spark, sf_dir):
    return Q.label_correlation(features(spark, sf_dir))


@register("column_medians", S.with_app_log(_union(
    [f"SELECT '{c}' AS feature, CAST(median({q(c)}) AS DOUBLE) AS median FROM feat" for c in MODEL_NUMERIC]),
    features=True))
def column_medians(spark, sf_dir):
    return Q.column_medians(features(spark, sf_dir), MODEL_NUMERIC)


@register("vocabulary", S.with_app_log("""
SELECT DISTINCT column_name, value FROM (
  SELECT 'region' AS column_name, region AS value FROM app_log
  UNION ALL SELECT 'acquisition_channel', acquisition_channel FROM app_log
  UNION ALL SELECT 'age_group', list_filter(regexp_split_to_array(user_segment, '\\s+'), lambda x: x <> '')[1] FROM app_log
  UNION ALL SELECT 'user_type', array_to_string(list_filter(regexp_split_to_array(user_segment, '\\s+'), lambda x: x <> '')[2:], ' ') FROM app_log
) t WHERE value IS NOT NULL"""))
def vocabulary(spark, sf_dir):
    return fit_vocabulary(log_table(spark, sf_dir))


# --- metrics over the rule-scored fixture ------------------------------------------

SCORED_SQL = """
SELECT user_id, log_ts, purchase_24h AS label, round(purchase_intent / 4.0, 6) AS score,
  CAST(CASE WHEN round(purchase_intent / 4.0, 6) >= 0.3 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM feat"""
CONF_SQL = """
SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
       count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn FROM scored"""


def _scored(spark, sf_dir):
    return X.scored(log_table(spark, sf_dir))


def _m(body: str, **more) -> str:
    return S.with_app_log(body, features=True, scored=SCORED_SQL, conf=CONF_SQL, **more)


@register("target_distribution", _m(
    "SELECT label, count(*) AS rows, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM scored), 6) AS share "
    "FROM scored GROUP BY label"))
def target_distribution(spark, sf_dir):
    return MX.target_distribution(_scored(spark, sf_dir))


@register("class_weights", _m(
    "SELECT label, count(*) AS rows, round((SELECT CAST(count(*) AS DOUBLE) FROM scored) / "
    "((SELECT count(DISTINCT label) FROM scored) * count(*)), 6) AS weight FROM scored GROUP BY label"))
def class_weights(spark, sf_dir):
    return MX.class_weights(_scored(spark, sf_dir))


@register("confusion_matrix", _m("""
SELECT 0 AS label, 0 AS prediction, tn AS rows FROM conf UNION ALL
SELECT 0, 1, fp FROM conf UNION ALL SELECT 1, 0, fn FROM conf UNION ALL SELECT 1, 1, tp FROM conf"""))
def confusion_matrix(spark, sf_dir):
    return MX.confusion_matrix(_scored(spark, sf_dir))


def _sd(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


@register("binary_metrics", _m(f"""
SELECT round({_sd('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, round({_sd('tp', 'tp + fp')}, 6) AS precision,
       round({_sd('tp', 'tp + fn')}, 6) AS recall, round({_sd('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM conf"""))
def binary_metrics(spark, sf_dir):
    return MX.binary_metrics(_scored(spark, sf_dir))


CLASS_SQL = f"""
SELECT {_sd('tn', 'tn + fn')} AS p0, {_sd('tn', 'tn + fp')} AS r0, {_sd('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0,
       {_sd('tp', 'tp + fp')} AS p1, {_sd('tp', 'tp + fn')} AS r1, {_sd('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS s1,
       tp + fp + fn + tn AS n, {_sd('tp + tn', 'tp + fp + fn + tn')} AS acc
FROM conf"""


@register("class_report", _m(f"""
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM cr UNION ALL
  SELECT '1', p1, r1, f1, s1 FROM cr UNION ALL
  SELECT 'accuracy', NULL, NULL, acc, n FROM cr UNION ALL
  SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM cr UNION ALL
  SELECT 'weighted avg', {_sd('p0 * s0 + p1 * s1', 'n')}, {_sd('r0 * s0 + r1 * s1', 'n')}, {_sd('f0 * s0 + f1 * s1', 'n')}, n FROM cr
) t""", cr=CLASS_SQL))
def class_report(spark, sf_dir):
    return MX.class_report(_scored(spark, sf_dir))


@register("roc_auc", _m("""
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT score AS s, CAST(count_if(label = 1) AS DOUBLE) AS pos, CAST(count_if(label = 0) AS DOUBLE) AS neg
        FROM scored GROUP BY score) a) b"""))
def roc_auc(spark, sf_dir):
    return MX.roc_auc(_scored(spark, sf_dir))


# --- preparation ----------------------------------------------------------------------

SPLIT_SQL = f"""
SELECT *, h <= threshold AS is_test FROM (
  SELECT f.*, t.threshold FROM (
    SELECT *, CAST(('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(log_ts AS VARCHAR), '{C.RANDOM_STATE}')), 1, 8)) AS BIGINT) AS h
    FROM feat) f
  LEFT JOIN (
    SELECT purchase_24h, h AS threshold FROM (
      SELECT purchase_24h, h, row_number() OVER (PARTITION BY purchase_24h ORDER BY h) AS rn,
             count(*) OVER (PARTITION BY purchase_24h) AS n
      FROM (SELECT purchase_24h, CAST(('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST(log_ts AS VARCHAR), '{C.RANDOM_STATE}')), 1, 8)) AS BIGINT) AS h FROM feat) x
    ) y WHERE rn = CAST(ceil(n * CAST({C.TEST_SHARE} AS DOUBLE)) AS BIGINT)
  ) t USING (purchase_24h)
) z"""


def _split(spark, sf_dir):
    return split_rows(spark, sf_dir)


@register("stratified_split", S.with_app_log("SELECT user_id, log_ts, purchase_24h, is_test FROM split",
                                              features=True, split=SPLIT_SQL))
def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("user_id", "log_ts", C.TARGET, "is_test")


@register("model_columns", S.with_app_log("SELECT * EXCLUDE (user_id, log_ts) FROM feat", features=True))
def model_columns(spark, sf_dir):
    return P.model_frame(features(spark, sf_dir))


_imp_cols = [c for c in MODEL_NUMERIC]
IMPUTE_SQL = "SELECT " + ", ".join(
    [f"coalesce(CAST({q(c)} AS DOUBLE), (SELECT CAST(median({q(c)}) AS DOUBLE) FROM feat)) AS {q(c)}" for c in _imp_cols]
    + [C.TARGET] + [f"coalesce({q(c)}, false) AS {q(c)}" for c in sorted(ONE_HOT)]) + " FROM feat"


@register("impute", S.with_app_log(IMPUTE_SQL, features=True))
def impute(spark, sf_dir):
    m = P.model_frame(features(spark, sf_dir))
    return P.impute(m, cols=MODEL_NUMERIC)


@register("scaler_fit", S.with_app_log(_union(
    [f"SELECT {i} AS pos, '{c}' AS feature, round(avg(CAST({q(c)} AS DOUBLE)), 6) AS mean, "
     f"round(stddev_pop(CAST({q(c)} AS DOUBLE)), 6) AS std, "
     f"round(CASE WHEN stddev_pop(CAST({q(c)} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({q(c)} AS DOUBLE)) END, 6) AS scale "
     f"FROM split WHERE NOT is_test" for i, c in enumerate(MODEL_NUMERIC)]), features=True, split=SPLIT_SQL))
def scaler_fit(spark, sf_dir):
    train = _split(spark, sf_dir).where(~F.col("is_test"))
    s = P.scaler_fit(train, MODEL_NUMERIC)
    return s.select("pos", "feature", *[F.round(c, 6).alias(c) for c in ("mean", "std", "scale")])


_scale_params = ", ".join(
    f"avg(CAST({q(c)} AS DOUBLE)) AS m{i}, "
    f"CASE WHEN stddev_pop(CAST({q(c)} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({q(c)} AS DOUBLE)) END AS s{i}"
    for i, c in enumerate(MODEL_NUMERIC))


@register("scaled_features", S.with_app_log(
    "SELECT user_id, log_ts, " + ", ".join(
        f"round((CAST({q(c)} AS DOUBLE) - m{i}) / s{i}, 6) AS {q(c)}" for i, c in enumerate(MODEL_NUMERIC))
    + " FROM split, params", features=True, split=SPLIT_SQL,
    params=f"SELECT {_scale_params} FROM split WHERE NOT is_test"))
def scaled_features(spark, sf_dir):
    sp = _split(spark, sf_dir)
    scaled = P.apply_scaler(sp, MODEL_NUMERIC, fit=sp.where(~F.col("is_test")))
    return scaled.select("user_id", "log_ts", *[F.round(c, 6).alias(c) for c in MODEL_NUMERIC])


MODEL_FEATURES = [c for c in FEATURE_TABLE if c not in ("user_id", "log_ts", C.TARGET)]


@register("align_features", S.with_app_log(
    "SELECT " + ", ".join("coalesce(platform, 0) AS platform" if c == "platform" else q(c) for c in MODEL_FEATURES)
    + " FROM feat", features=True))
def align_features(spark, sf_dir):
    served = featurize(log_table(spark, sf_dir), C.FIXTURE_VOCABULARY, mode="serve")
    return P.align_features(served, MODEL_FEATURES)


_row_text = ", ".join(
    "coalesce(" + (f"strftime({c}, '%Y-%m-%d %H:%M:%S') || coalesce(nullif(rtrim('.' || lpad(CAST(microsecond({c}) % 1000000 AS VARCHAR), 6, '0'), '0'), '.'), '')"
                   if c == "log_ts" else f"CAST({c} AS VARCHAR)") + ", 'null')" for c in RAW_COLUMNS)


@register("batch_fingerprint", S.with_app_log(f"""
SELECT count(*) AS record_count,
  CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {_row_text})), 1, 15) AS BIGINT) % 2147483648), 0) AS BIGINT) AS fingerprint
FROM app_log"""))
def batch_fingerprint(spark, sf_dir):
    return Q.batch_fingerprint(log_table(spark, sf_dir).select(*RAW_COLUMNS))
