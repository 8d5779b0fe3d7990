"""Queries: ingest, merge and versions (S3, S4, S6, S14, J1, J2, U1, P1, P2,
A1, A3, S11, A2, A6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import ingest as I
from ..operators import merge as M
from .. import config as C
from ..operators.featurize import feature_columns, featurize, one_hot_columns
from ..operators.quality import feature_run_stats
from ..operators.vocab import vocabulary_dict
from ..session import ensure_checkpoint_dir, stored
from ..sources import files, keyindex, vocabulary
from . import fixtures as X
from . import runs
from . import sql as S
from .catalog import features, input_key, log_table, register

# raw passthrough columns + label + derived features
FEATURE_TABLE_WIDTH = 9 + 1 + len(feature_columns(C.FIXTURE_VOCABULARY))
CUT = f"TIMESTAMP '{X.CUTOFF}'"
HASH_SQL = (f"md5(concat_ws('|', coalesce(trim(CAST(user_id AS VARCHAR)), 'nan'), "
            f"coalesce(strftime({S.parse_date_sql('first_visit_date')}, '%Y-%m-%d'), trim(first_visit_date), 'nan')))")
STORED_SQL = f"SELECT *, {HASH_SQL} AS record_hash FROM app_log WHERE log_ts < {CUT} OR user_id % 5 = 0"
BATCH_SQL = f"SELECT *, {HASH_SQL} AS record_hash FROM app_log"
# In-batch reduction: one row per hash (latest log_ts); hashes are unique in
# the fixture, so the reduction keeps every row.
NEW_SQL = "SELECT b.* FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.record_hash = b.record_hash)"
GATED_SQL = "SELECT * FROM new_rows WHERE (SELECT count(*) FROM new_rows) >= 200"


def _ingest_ctes(**more):
    return dict(stored=STORED_SQL, batch=BATCH_SQL, new_rows=NEW_SQL, **more)


@register("hash_keys", S.with_app_log(f"SELECT {HASH_SQL} AS record_hash FROM app_log"))
def hash_keys(spark, sf_dir):
    return I.with_record_hash(log_table(spark, sf_dir)).select("record_hash")


@register("new_records", S.with_app_log("SELECT * FROM new_rows", **_ingest_ctes()))
def new_records(spark, sf_dir):
    log = log_table(spark, sf_dir)
    return I.new_records(I.with_record_hash(log), X.stored_log(log))


@register("gated_batch", S.with_app_log("SELECT * FROM gated", **_ingest_ctes(gated=GATED_SQL)))
def gated_batch(spark, sf_dir):
    log = log_table(spark, sf_dir)
    return I.gate(I.new_records(I.with_record_hash(log), X.stored_log(log)), 200)


@register("upsert_log", S.with_app_log("SELECT * FROM stored UNION ALL SELECT * FROM gated",
                                        **_ingest_ctes(gated=GATED_SQL)))
def upsert_log(spark, sf_dir):
    log = log_table(spark, sf_dir)
    _, after = I.upsert(X.stored_log(log), I.with_record_hash(log))
    return after


@register("duplicate_keys", S.with_app_log(
    "SELECT record_hash, count(*) AS copies FROM (SELECT record_hash FROM stored UNION ALL SELECT record_hash FROM batch) u "
    "GROUP BY record_hash HAVING count(*) > 1", **_ingest_ctes()))
def duplicate_keys(spark, sf_dir):
    """Uniqueness audit over the store plus the raw landing batch: the keys a
    unique index would reject (the upsert itself leaves none, see tests)."""
    log = log_table(spark, sf_dir)
    stored = X.stored_log(log)
    return I.duplicate_keys(stored.unionByName(I.with_record_hash(log)))


@register("ingest_stats", S.with_app_log("""
SELECT (SELECT count(*) FROM batch) AS batch_records,
       (SELECT count(DISTINCT record_hash) FROM batch) AS distinct_records,
       (SELECT count(*) FROM gated) AS inserted_records,
       (SELECT count(*) FROM stored) AS stored_before,
       (SELECT count(*) FROM stored) + (SELECT count(*) FROM gated) AS stored_after""",
    **_ingest_ctes(gated=GATED_SQL)))
def ingest_stats(spark, sf_dir):
    log = log_table(spark, sf_dir)
    stored, batch = X.stored_log(log), I.with_record_hash(log)
    fresh, _ = I.upsert(stored, batch)
    return I.ingest_stats(stored, batch, fresh)


EXISTING_SQL = f"SELECT * FROM app_log WHERE log_ts < {CUT} AND user_id % 3 <> 0"
NEWLOG_SQL = f"SELECT * FROM app_log WHERE log_ts >= {CUT}"


@register("high_water_mark", S.with_app_log("SELECT max(log_ts) AS high_water_mark FROM existing",
                                             existing=EXISTING_SQL))
def high_water_mark(spark, sf_dir):
    return M.high_water_mark(X.existing_log(log_table(spark, sf_dir)))


@register("incremental_rows", S.with_app_log(
    "SELECT * FROM app_log WHERE log_ts > (SELECT max(log_ts) FROM existing)", existing=EXISTING_SQL))
def incremental_rows(spark, sf_dir):
    log = log_table(spark, sf_dir)
    return M.incremental_rows(log, X.existing_log(log))


@register("merge_existing_wins", S.with_app_log("""
SELECT * FROM fe
UNION ALL
SELECT * FROM fn WHERE NOT EXISTS (SELECT 1 FROM fe WHERE fe.user_id = fn.user_id)""",
    existing=EXISTING_SQL, newlog=NEWLOG_SQL,
    fe=S.features_sql("existing"), fn=S.features_sql("newlog")))
def merge_existing_wins(spark, sf_dir):
    log = log_table(spark, sf_dir)
    return M.merge_existing_wins(featurize(X.existing_log(log), C.FIXTURE_VOCABULARY), featurize(X.new_log(log), C.FIXTURE_VOCABULARY))


RUNS_SQL = """
SELECT CAST(day AS VARCHAR) AS processing_version, processed_at,
  CAST(sum(new_record_count) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS record_count,
  new_record_count, id_count, round(purchase_rate, 6) AS purchase_rate, 'retail' AS domain
FROM (SELECT CAST(log_ts AS DATE) AS day, max(log_ts) AS processed_at, count(*) AS new_record_count,
             count(DISTINCT user_id) AS id_count, avg(purchase_24h) AS purchase_rate
      FROM feat GROUP BY 1) d"""


@register("feature_runs", S.with_app_log("SELECT * FROM runs", features=True, runs=RUNS_SQL))
def feature_runs(spark, sf_dir):
    return X.feature_runs(log_table(spark, sf_dir))


@register("load_latest_version", S.with_app_log(
    "SELECT * EXCLUDE (processing_version), (SELECT arg_max(processing_version, processed_at) FROM runs) AS processing_version "
    "FROM (SELECT *, CAST(CAST(log_ts AS DATE) AS VARCHAR) AS processing_version FROM feat) v "
    "WHERE processing_version IN (SELECT processing_version FROM runs)",
    features=True, runs=RUNS_SQL))
def load_latest_version(spark, sf_dir):
    log = log_table(spark, sf_dir)
    versioned = featurize(log, C.FIXTURE_VOCABULARY).withColumn("processing_version", F.to_date("log_ts").cast("string"))
    return M.load_version(versioned, X.feature_runs(log))


@register("feature_run_stats", S.with_app_log(f"""
SELECT count(*) AS record_count, count(DISTINCT user_id) AS id_count, round(avg(purchase_24h), 6) AS purchase_rate,
       max(log_ts) AS last_processed_timestamp, CAST({FEATURE_TABLE_WIDTH} AS BIGINT) AS feature_count,
       'retail' AS domain
FROM feat""", features=True))
def feature_run_stats_q(spark, sf_dir):
    return feature_run_stats(features(spark, sf_dir))


# --- run jobs over a store -------------------------------------------------------

_JOB_STORES: dict[tuple, str] = {}
GATE = C.MIN_INGEST_BATCH
# What the two ingest runs of the job store add. The first hands over the rows of
# ``existing_log``: with fewer than the gate's rows it is held back, and they
# arrive with the second, which hands over every row.
_JOB_CTES = dict(
    hashed=f"SELECT *, {HASH_SQL} AS record_hash FROM app_log",
    first_batch=f"SELECT * FROM hashed WHERE log_ts < {CUT} AND user_id % 3 <> 0",
    first_run=f"SELECT * FROM first_batch WHERE (SELECT count(*) FROM first_batch) >= {GATE}",
    second_batch="SELECT * FROM hashed WHERE record_hash NOT IN (SELECT record_hash FROM first_run)",
    second_run=f"SELECT * FROM second_batch WHERE (SELECT count(*) FROM second_batch) >= {GATE}",
    added="SELECT * FROM second_run WHERE user_id NOT IN (SELECT user_id FROM first_run)")


def _job_store(spark, sf_dir, kind: str, parts) -> str:
    """A store root on which ingest and featurization ran over each part, built
    once per session and input."""
    key = (*input_key(spark, sf_dir), kind)
    if key not in _JOB_STORES:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
        for n, part in enumerate(parts(log_table(spark, sf_dir)), 1):
            runs.ingest_batch(spark, part, root, f"ingest_{n}")
            runs.featurize_increment(spark, root, f"v{n}")
        _JOB_STORES[key] = root
    return _JOB_STORES[key]


def job_store(spark, sf_dir) -> str:
    return _job_store(spark, sf_dir, "log", lambda log: [X.existing_log(log), log])


@register("ingest_runs", S.with_app_log("""
SELECT 'ingest_1' AS run_id, max(log_ts) AS last_processed_timestamp, count(*) AS record_count FROM first_run HAVING count(*) > 0
UNION ALL SELECT 'ingest_2', max(log_ts), count(*) FROM second_run HAVING count(*) > 0""", **_JOB_CTES))
def ingest_runs(spark, sf_dir):
    return files.read_runs(spark, job_store(spark, sf_dir), "ingest_runs").select("run_id", "last_processed_timestamp", "record_count")


@register("incremental_store", S.with_app_log(
    "SELECT * FROM first_run UNION ALL SELECT * FROM second_run", **_JOB_CTES))
def incremental_store(spark, sf_dir):
    return files.read_raw(spark, job_store(spark, sf_dir))


@register("feature_store_runs", S.with_app_log("""
SELECT 'v1' AS processing_version, count(*) AS record_count, count(*) AS new_record_count, count(DISTINCT user_id) AS id_count,
  round(avg(purchase_24h), 6) AS purchase_rate, max(log_ts) AS last_processed_timestamp FROM first_features HAVING count(*) > 0
UNION ALL
SELECT 'v2', (SELECT count(*) FROM merged), (SELECT count(*) FROM added), (SELECT count(DISTINCT user_id) FROM merged),
  (SELECT round(avg(purchase_24h), 6) FROM merged), max(log_ts) FROM second_run HAVING count(*) > 0""", **_JOB_CTES,
    first_features=S.features_sql("first_run"), added_features=S.features_sql("added"),
    merged="SELECT * FROM first_features UNION ALL SELECT * FROM added_features"))
def feature_store_runs(spark, sf_dir):
    return files.read_runs(spark, job_store(spark, sf_dir)).select(
        "processing_version", "record_count", "new_record_count", "id_count", "purchase_rate", "last_processed_timestamp")


@register("unseen_keys", S.with_app_log("SELECT * FROM new_rows", **_ingest_ctes()))
def unseen_keys(spark, sf_dir):
    """As ``new_records``, through the key index: stored hashes by run and prefix."""
    log = log_table(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keys-{uuid.uuid4().hex}"
    keyindex.add_keys(X.stored_log(log).select(F.col("record_hash").alias("key")), root, "log_keys", "r1")
    reduced = stored(I.reduce_by_hash(I.with_record_hash(log)), "reduced")
    return keyindex.unseen(reduced, F.col("record_hash"), root, "log_keys", ["r1"])


# --- categories that the log brings ------------------------------------------------

# A log of other shops: regions, channels and segments of their own, some of which
# the first part has not.
_OTHER = {"region": ("region || ' ' || CASE user_id % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'St. South' ELSE 'Mid' END"),
          "acquisition_channel": "'ch' || (user_id % 6)", "user_segment": "CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'Group' || (user_id % 3) || ' Kind ' || (user_id % 2) END"}
_OTHER_SQL = "SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _OTHER.items()) + ") FROM app_log"
_OTHER_CTES = {**_JOB_CTES, "hashed": f"SELECT *, {HASH_SQL} AS record_hash FROM ({_OTHER_SQL}) t",
               "first_batch": f"SELECT * FROM hashed WHERE user_id % 4 <> 0 AND log_ts < {CUT}"}
_PAIRS = """SELECT DISTINCT column_name, value FROM (
  SELECT 'region' AS column_name, region AS value FROM {0} UNION ALL SELECT 'acquisition_channel', acquisition_channel FROM {0}
  UNION ALL SELECT 'age_group', split_part(user_segment, ' ', 1) FROM {0}
  UNION ALL SELECT 'user_type', regexp_replace(user_segment, '^[^ ]* ', '') FROM {0}) t WHERE value IS NOT NULL"""
_VOCABULARY_SQL = ("SELECT 'v1' AS processing_version, column_name, value FROM (" + _PAIRS.format("first_run") + ") a UNION ALL "
                   "SELECT 'v2', column_name, value FROM ((" + _PAIRS.format("second_run") + ") EXCEPT (" + _PAIRS.format("first_run") + ")) b")


def other_store(spark, sf_dir) -> str:
    def parts(log):
        other = log.withColumns({c: F.expr(e) for c, e in _OTHER.items()})
        return [other.where((F.col("user_id") % 4 != 0) & (F.col("log_ts") < X.cutoff())), other]

    return _job_store(spark, sf_dir, "other", parts)


@register("vocabulary_versions", S.with_app_log(_VOCABULARY_SQL, **_OTHER_CTES))
def vocabulary_versions(spark, sf_dir):
    """Categories by the version that saw them first."""
    return vocabulary.load_vocabulary(spark, other_store(spark, sf_dir)).select("processing_version", "column_name", "value")


@register("category_columns", S.with_app_log(f"""
SELECT lower(CASE column_name WHEN 'acquisition_channel' THEN 'channel' ELSE column_name END || '_' || replace(value, '.', '_')) AS feature,
  (SELECT count(*) FROM rows_v1 r WHERE CASE column_name WHEN 'region' THEN r.region WHEN 'acquisition_channel' THEN r.acquisition_channel
     WHEN 'age_group' THEN r.age_group ELSE r.user_type END = value) AS rows_before,
  (SELECT count(*) FROM rows_all r WHERE CASE column_name WHEN 'region' THEN r.region WHEN 'acquisition_channel' THEN r.acquisition_channel
     WHEN 'age_group' THEN r.age_group ELSE r.user_type END = value) AS rows_now
FROM ({_VOCABULARY_SQL}) v""", **_OTHER_CTES,
    rows_v1="SELECT *, split_part(user_segment, ' ', 1) AS age_group, regexp_replace(user_segment, '^[^ ]* ', '') AS user_type FROM first_run",
    rows_all="SELECT * FROM rows_v1 UNION ALL SELECT *, split_part(user_segment, ' ', 1), regexp_replace(user_segment, '^[^ ]* ', '') FROM added"))
def category_columns(spark, sf_dir):
    """Rows that have each one-hot column true, before and after the second run;
    a column that the second run brought is false in the rows before."""
    root = other_store(spark, sf_dir)
    now = files.load_features(spark, root)
    first = files.read_runs(spark, root).where("processing_version = 'v1'").isEmpty()
    names = one_hot_columns(vocabulary_dict(vocabulary.load_vocabulary(spark, root)))
    before = now.limit(0) if first else files.load_features(spark, root, "v1")
    before = before.withColumns({c: F.lit(False) for c in names if c not in before.columns})

    def counts(df, name):
        one = df.agg(*[F.count_if(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
        rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias(name)) for i, c in enumerate(names)])
        return one.select(F.explode(rows).alias("r")).select("r.*")

    return counts(before, "rows_before").join(counts(now, "rows_now"), "feature")
