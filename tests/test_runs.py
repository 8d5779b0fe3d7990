"""Run jobs and streams with their default gates: nothing is lost, counted twice
or read as empty by mistake."""

import os
import tempfile

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from purchase_signals import config as C
from purchase_signals.operators import model as ML
from purchase_signals.operators import prepare as P
from purchase_signals.plans import fixtures as X
from purchase_signals.plans import runs
from purchase_signals.sources import files, registry
from purchase_signals.sources.tables import app_log
from purchase_signals.streaming import jobs


@pytest.fixture(scope="module")
def log(spark):
    return app_log(spark, SF_SMALL).cache()


def share(log, lo, hi):
    """Rows whose key hash falls in a part of the range."""
    h = F.pmod(F.xxhash64("user_id", "log_ts"), F.lit(100))
    return log.where((h >= lo) & (h < hi))


def root_of(kind="plain"):
    d = tempfile.mkdtemp(prefix="ps-store-")
    return f"file://{d}/store" if kind == "uri" else f"{d}/store"


def test_small_landings_wait_and_all_arrive(spark, log):
    landing, root = tempfile.mkdtemp(prefix="ps-landing-"), root_of()
    total, stored_after = log.count(), []
    assert 3 * C.MIN_INGEST_BATCH > total > C.MIN_INGEST_BATCH
    for n, (lo, hi) in enumerate([(0, 25), (25, 40), (40, 100)]):
        files.export_csv(share(log, lo, hi), os.path.join(landing, f"part{n}"))
        jobs.ingest_stream(spark, landing + "/*", root, fmt="csv").awaitTermination()
        stored_after.append(files.read_or_empty(spark, f"{root}/raw_log", files.STORED_LOG_SCHEMA).count())
        jobs.featurize_stream(spark, root).awaitTermination() if stored_after[-1] else None
    assert stored_after[0] == 0 and stored_after[-1] == total
    assert files.load_features(spark, root).count() == total
    rows = files.read_runs(spark, root, "ingest_runs").collect()
    assert sum(r.record_count for r in rows) == total
    assert all(len(r.sample_hashes) == 5 and r.last_processed_timestamp is not None for r in rows)


def test_first_ingest_below_the_gate(spark, log):
    root = root_of()
    few = log.limit(150)
    assert runs.ingest_batch(spark, few, root, "a") == {"ingest_run": "a", "inserted": 0, "pending": 150}
    assert runs.featurize_increment(spark, root, "v1") is None
    assert runs.ingest_batch(spark, few, root, "a")["pending"] == 150  # a retry holds the same rows back once
    assert runs.ingest_batch(spark, log, root, "b")["inserted"] == log.count()
    assert runs.ingest_batch(spark, log, root, "c")["inserted"] == 0


def test_featurize_gate_keeps_rows_for_the_next_run(spark, log):
    root = root_of()
    runs.ingest_batch(spark, log, root, "a", min_batch=1)
    assert runs.featurize_increment(spark, root, "v1", min_batch=10**6) is None
    assert runs.featurize_increment(spark, root, "v2") == "v2"
    assert files.load_features(spark, root).count() == log.count()
    assert runs.featurize_increment(spark, root, "v3", min_batch=1) is None


@pytest.mark.parametrize("kind", ["plain", "uri"])
def test_retry_after_commit_leaves_one_run_row(spark, log, kind):
    root = root_of(kind)
    for n, part in enumerate([X.existing_log(log), log], 1):
        runs.ingest_batch(spark, part, root, f"i{n}", min_batch=1)
        runs.featurize_increment(spark, root, f"v{n}", min_batch=1)
    before = {r.processing_version: r for r in files.read_runs(spark, root).collect()}
    runs.ingest_batch(spark, log, root, "i2", min_batch=1)
    assert runs.featurize_increment(spark, root, "v2", min_batch=1) == "v2"
    after = {r.processing_version: r for r in files.read_runs(spark, root).collect()}
    assert set(after) == {"v1", "v2"} and files.read_runs(spark, root).count() == 2
    for field in ("record_count", "new_record_count", "id_count", "last_processed_timestamp"):
        assert after["v2"][field] == before["v2"][field]
    assert files.load_features(spark, root).count() == after["v2"].record_count
    assert files.read_raw(spark, root).count() == log.count()


def test_known_users_move_the_mark_and_count_nothing_new(spark, log):
    root = root_of()
    runs.ingest_batch(spark, log, root, "a")
    runs.featurize_increment(spark, root, "v1")
    later = log.limit(150).withColumn("log_ts", F.expr("log_ts + INTERVAL 400 DAYS")).withColumn("first_visit_date", F.lit("2026-01-01"))
    later = later.dropDuplicates(["user_id"])
    runs.ingest_batch(spark, later, root, "b", min_batch=1)
    assert runs.featurize_increment(spark, root, "v2", min_batch=1) == "v2"
    run = {r.processing_version: r for r in files.read_runs(spark, root).collect()}
    assert run["v2"].new_record_count == 0 and run["v2"].record_count == run["v1"].record_count
    assert run["v2"].last_processed_timestamp > run["v1"].last_processed_timestamp
    assert runs.featurize_increment(spark, root, "v3", min_batch=1) is None


def test_other_read_faults_are_raised(spark):
    with pytest.raises((AnalysisException, Py4JJavaError)):
        files.read_or_empty(spark, "nosuchscheme://x/y", files.STORED_LOG_SCHEMA).count()
    assert files.read_or_empty(spark, root_of(), files.STORED_LOG_SCHEMA).count() == 0


def test_train_score_and_mark(spark, log):
    root = root_of()
    runs.ingest_batch(spark, log, root, "a")
    runs.featurize_increment(spark, root, "v1")
    small = ML.ForestParams(num_trees=5, max_depth=5)
    got = runs.train_and_promote(spark, root, "m1", params=small, cv=False)
    assert got["promoted"] and got["test_f1_score"] > 0
    assert runs.train_and_promote(spark, root, "m2", params=small, cv=False) is None  # fresh model, nothing new
    inbox = X.to_score(log)
    key = ["user_id", "log_ts"]
    pending = inbox.where(~F.col("predicted").eqNullSafe(True)).count()
    assert runs.score_pending(spark, root, inbox, "p1") == pending
    assert runs.score_pending(spark, root, inbox, "p1") == pending  # a retry replaces its rows
    assert runs.score_pending(spark, root, inbox, "p2") == 0
    stored = spark.read.parquet(f"{root}/predictions")
    assert stored.count() == pending and {"screen_list", "app_version", "prediction", "probability"} <= set(stored.columns)
    assert runs.scored_flags(spark, root, inbox).where(~F.col("predicted")).count() == 0
    row = files.read_runs(spark, root, "prediction_runs").collect()
    assert [(r.prediction_id, r.model_version, r.record_count) for r in row] == [("p1", "m1", pending)]
    assert registry.active_version(spark, root).first().model_version == "m1"


def test_folds_are_stratified_and_stable(spark, log):
    from purchase_signals.operators.featurize import featurize

    f = featurize(log, C.FIXTURE_VOCABULARY).select("user_id", "log_ts", C.TARGET)
    a = P.stratified_folds(f, ["user_id", "log_ts"])
    sizes = {}
    for r in a.groupBy(C.TARGET, "fold").count().collect():
        sizes.setdefault(r[C.TARGET], []).append(r["count"])
    assert all(len(s) == C.CV_FOLDS and max(s) - min(s) <= 1 for s in sizes.values())
    assert a.exceptAll(P.stratified_folds(f.repartition(7), ["user_id", "log_ts"])).count() == 0


def test_medians_without_value_maps(spark):
    from purchase_signals.operators import quality as Q

    df = spark.range(30001).selectExpr("cast(id as double) * 3 as a", "id % 7 as b", "if(id % 2 = 0, null, id) as c", "cast(null as double) as d",
                                       "cast(1 as int) as e")
    got = {r.feature: r.median for r in Q.column_medians(df, ["a", "b", "c", "d", "e"]).collect()}
    assert got == {"a": 45000.0, "b": 3.0, "c": 15000.0, "d": None, "e": 1.0}
    plan = Q.column_medians(df, ["a"])._jdf.queryExecution().toString()
    assert "median(" not in plan.replace("AS median", "")


def test_wide_vocabulary(spark, log):
    from purchase_signals.operators.featurize import featurize
    from purchase_signals.operators.vocab import fit_vocabulary, vocabulary_dict

    wide = log.withColumn("region", F.concat(F.lit("r"), (F.pmod(F.xxhash64("user_id", "log_ts"), F.lit(300))).cast("string")))
    vocab = vocabulary_dict(fit_vocabulary(wide))
    got = featurize(wide, vocab=vocab)
    names = [c for c in got.columns if c.startswith("region_")]
    assert len(names) == len(vocab["region"]) > 100
    assert got.select(sum(F.col(c).cast("int") for c in names).alias("n")).where("n <> 1").count() == 0
