"""Invariants for the MLlib operators (no SQL oracle) and the streaming /
file jobs (need files, a stream or driver state)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from purchase_signals import config as C
from purchase_signals.operators import model as ML
from purchase_signals.operators import prepare as P
from purchase_signals.operators.featurize import featurize
from purchase_signals.plans import fixtures as X
from purchase_signals.plans import runs
from purchase_signals.sources import files
from purchase_signals.sources.tables import app_log
from purchase_signals.streaming import jobs

SMALL_FOREST = ML.ForestParams(num_trees=20, max_depth=8)
KEY = ["user_id", "log_ts"]


@pytest.fixture(scope="module")
def trained(spark):
    f = featurize(app_log(spark, SF_SMALL), C.FIXTURE_VOCABULARY)
    prepared, feats, nums, scaler = P.prepare_training(f, KEY)
    prepared = prepared.checkpoint()
    model = ML.train_forest(prepared.where(~F.col("is_test")), feats, C.TARGET, SMALL_FOREST)
    return model, prepared, feats, nums, scaler


def test_probabilities_and_importances(spark, trained):
    model, prepared, feats, _, _ = trained
    pred = ML.predict(model, prepared.where(F.col("is_test")), feats, [C.TARGET])
    rows = pred.collect()
    assert rows and all(0.0 <= r.probability <= 1.0 for r in rows)
    assert all((r.probability > 0.5) == (r.prediction == 1) for r in rows if abs(r.probability - 0.5) > 1e-9)
    imp = ML.importances(spark, model, feats, top=None).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert len(ML.importances(spark, model, feats).collect()) == C.TOP_IMPORTANCES
    m = ML.evaluate(pred).first()
    assert 0.0 <= m.roc_auc <= 1.0 and 0.0 <= m.f1 <= 1.0


def test_same_seed_same_model(spark, trained):
    model, prepared, feats, _, _ = trained
    again = ML.train_forest(prepared.where(~F.col("is_test")), feats, C.TARGET, SMALL_FOREST)
    test = prepared.where(F.col("is_test"))
    a = sorted(r.probability for r in ML.predict(model, test, feats, [C.TARGET]).collect())
    b = sorted(r.probability for r in ML.predict(again, test, feats, [C.TARGET]).collect())
    assert a == pytest.approx(b)


def test_prepared_frame(trained):
    _, prepared, feats, nums, scaler = trained
    assert "user_id" not in feats and "log_ts" not in feats and {"user_id", "log_ts"} <= set(prepared.columns)
    assert prepared.where(F.greatest(*[F.col(c).isNull().cast("int") for c in nums]) == 1).count() == 0
    train = prepared.where(~F.col("is_test"))
    means = train.agg(*[F.avg(c).alias(c) for c in nums]).first()
    assert all(abs(means[c]) < 1e-9 for c in nums)
    assert scaler.count() == len(nums)


def test_train_serve_parity_on_clean_rows(spark, trained):
    """Rows without missing values give the same features in both modes."""
    log = app_log(spark, SF_SMALL).where(F.col("platform").isNotNull() & F.col("screen_list").isNotNull())
    a = featurize(log, C.FIXTURE_VOCABULARY).drop(C.TARGET)
    b = featurize(log, C.FIXTURE_VOCABULARY, mode="serve")
    assert sorted(a.columns) == sorted(b.columns)
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_cross_validate_rows(spark, trained):
    _, prepared, feats, _, _ = trained
    train = prepared.where(~F.col("is_test"))
    cv = {r.fold: r.weighted_f1 for r in ML.cross_validate(spark, train, feats, KEY, k=3,
                                                            params=ML.ForestParams(num_trees=5, max_depth=5)).collect()}
    assert set(cv) == {"0", "1", "2", "mean", "std"}
    assert all(0.0 <= cv[k] <= 1.0 for k in ("0", "1", "2"))


def test_versioned_features_and_commit(spark):
    root = tempfile.mkdtemp(prefix="ps-store-")
    log = app_log(spark, SF_SMALL)
    first = X.existing_log(log)
    assert runs.featurize_increment(spark, root, "v1", first, min_batch=1) == "v1"
    # batch mode: only rows after the committed high-water mark
    hw = first.agg(F.max("log_ts")).first()[0]
    todo = log.where(F.col("log_ts") > hw)
    assert runs.featurize_increment(spark, root, "v2", todo, min_batch=1) == "v2"
    latest = files.load_features(spark, root)
    old_users = {r.user_id for r in first.select("user_id").distinct().collect()}
    got = latest.collect()
    assert {r.processing_version for r in got} == {"v2"}
    # existing rows win: every known user keeps only its first-run rows
    assert len([r for r in got if r.user_id in old_users]) == first.count()
    assert files.load_features(spark, root, "v1").count() == first.count()
    # gated run writes nothing and commits nothing
    assert runs.featurize_increment(spark, root, "v3", todo.limit(5), min_batch=100) is None
    assert files.read_runs(spark, root).count() == 2


def test_csv_roundtrip_and_export(spark):
    d = tempfile.mkdtemp(prefix="ps-csv-")
    log = app_log(spark, SF_SMALL)
    files.export_csv(log, os.path.join(d, "log"))
    back = files.read_raw_csv(spark, os.path.join(d, "log"))
    assert back.count() == log.count()
    # CSV cannot tell an empty list from a missing one; features treat both alike
    norm = {"screen_list": F.coalesce("screen_list", F.lit(""))}
    assert back.withColumns(norm).exceptAll(log.withColumns(norm)).count() == 0
    assert featurize(back, C.FIXTURE_VOCABULARY).exceptAll(featurize(log, C.FIXTURE_VOCABULARY)).count() == 0


def test_ingest_stream_second_run_adds_nothing(spark):
    landing = tempfile.mkdtemp(prefix="ps-landing-")
    root = tempfile.mkdtemp(prefix="ps-store-")
    log = app_log(spark, SF_SMALL)
    files.export_csv(log.where(F.col("log_ts") < X.cutoff()), os.path.join(landing, "a"))
    q = jobs.ingest_stream(spark, landing + "/*", root, fmt="csv", min_batch=1)
    q.awaitTermination()
    n1 = files.read_raw(spark, root).count()
    # the same rows again in a new file plus the rest: only the rest is added
    files.export_csv(log, os.path.join(landing, "b"))
    q = jobs.ingest_stream(spark, landing + "/*", root, fmt="csv", min_batch=1)
    q.awaitTermination()
    stored = files.read_raw(spark, root)
    assert stored.count() == log.count() and n1 < log.count()
    assert stored.groupBy("record_hash").count().where("count > 1").count() == 0
    # nothing new: a third run adds nothing
    q = jobs.ingest_stream(spark, landing + "/*", root, fmt="csv", min_batch=1)
    q.awaitTermination()
    assert files.read_raw(spark, root).count() == log.count()


def test_featurize_and_score_streams(spark, trained):
    model, _, feats, nums, scaler = trained
    root = tempfile.mkdtemp(prefix="ps-store-")
    log = app_log(spark, SF_SMALL)
    from purchase_signals.operators.ingest import with_record_hash
    with_record_hash(log).withColumn("ingest_run", F.lit("r1")).write.partitionBy("ingest_run") \
        .parquet(os.path.join(root, "raw_log"))
    q = jobs.featurize_stream(spark, root, min_batch=1)
    q.awaitTermination()
    latest = files.load_features(spark, root)
    assert latest.count() == log.count()
    inbox = tempfile.mkdtemp(prefix="ps-inbox-")
    X.to_score(log).write.mode("overwrite").parquet(inbox)
    q = jobs.score_stream(spark, inbox, root, model, feats, scaler, nums, "m1", C.FIXTURE_VOCABULARY)
    q.awaitTermination()
    preds = spark.read.parquet(os.path.join(root, "predictions"))
    pending = X.to_score(log).where(~F.col("predicted").eqNullSafe(True)).count()
    assert preds.count() == pending
    assert preds.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def test_registry_promotion_and_load(spark, trained):
    from purchase_signals.sources import registry as R
    model, prepared, feats, nums, scaler = trained
    root = tempfile.mkdtemp(prefix="ps-reg-")
    with pytest.raises(LookupError):
        R.load_active_model(spark, root)
    R.register_model(spark, root, model, "m1", "v1", {"test_f1_score": 0.80}, feats, nums, scaler)
    R.register_model(spark, root, model, "m2", "v1", {"test_f1_score": 0.805}, feats, nums, scaler)
    R.register_model(spark, root, model, "m3", "v1", {"test_f1_score": 0.82}, feats, nums, scaler)
    assert R.promote_if_better(spark, root, "m1")
    assert not R.promote_if_better(spark, root, "m2")
    assert R.promote_if_better(spark, root, "m3")
    loaded, lfeats, lscaler, lscaled, version = R.load_active_model(spark, root)
    assert version == "m3" and lfeats == feats and lscaled == nums and lscaler.count() == len(nums)
    test = prepared.where(F.col("is_test"))
    a = sorted(r.probability for r in ML.predict(model, test, feats, [C.TARGET]).collect())
    b = sorted(r.probability for r in ML.predict(loaded, test, feats, [C.TARGET]).collect())
    assert a == pytest.approx(b)


def test_training_guard_and_artifacts(spark, trained):
    log = app_log(spark, SF_SMALL).limit(50)
    with pytest.raises(ValueError, match="insufficient"):
        P.prepare_training(featurize(log, C.FIXTURE_VOCABULARY), KEY)
    model, prepared, feats, _, _ = trained
    d = tempfile.mkdtemp(prefix="ps-art-")
    files.write_json(ML.importances(spark, model, feats, top=None), os.path.join(d, "importances"))
    back = spark.read.json(os.path.join(d, "importances"))
    assert back.count() == len(feats)


def test_prediction_sinks_and_source_tag(spark):
    root = tempfile.mkdtemp(prefix="ps-pred-")
    rows = spark.createDataFrame([(1, 0.7, 1, "pred_a"), (2, 0.2, 0, "pred_a")],
                                 "user_id long, probability double, prediction int, prediction_id string")
    files.append_predictions(rows, root)
    files.append_predictions(rows.withColumn("prediction_id", F.lit("pred_b")), root, source="interactive")
    out = spark.read.parquet(os.path.join(root, "predictions"))
    assert out.count() == 4
    assert out.where(F.col("prediction_source") == "interactive").count() == 2


def test_key_fields_default_timestamp_and_keep_hash(spark):
    from purchase_signals.operators import ingest as I
    df = spark.createDataFrame([(1, "2024-01-01")], "user_id long, first_visit_date string")
    assert I.validated_key_fields(df, ["user_id", "missing"]) == ["user_id"]
    with pytest.raises(ValueError):
        I.validated_key_fields(df, ["missing"])
    stamped = I.with_default_timestamp(df, "2024-02-01 00:00:00")
    assert stamped.first()["log_ts"].year == 2024
    hashed = I.with_record_hash(app_log(spark, SF_SMALL))
    assert "record_hash" in featurize(hashed, C.FIXTURE_VOCABULARY, keep_hash=True).columns
    assert "record_hash" not in featurize(hashed, C.FIXTURE_VOCABULARY).columns


def test_single_record_scoring_with_active_model(spark, trained):
    """One record as a one-row DataFrame; categories that the vocabulary has
    not seen become all-false."""
    from purchase_signals.sources import registry as R
    model, _, feats, nums, scaler = trained
    root = tempfile.mkdtemp(prefix="ps-one-")
    R.register_model(spark, root, model, "m1", "v1", {"test_f1_score": 0.9}, feats, nums, scaler)
    assert R.promote_if_better(spark, root, "m1")
    record = {"user_id": 77001, "platform": "Android", "age": 52, "session_count": 9, "total_screens_viewed": 4,
              "used_search_feature": 0, "wrote_review": 1, "added_to_wishlist": 0, "screen_list": "Search,Nowhere",
              "region": "ATLANTIS", "acquisition_channel": "Pigeon", "user_segment": "Ancient Mariner",
              "app_version": "2.7", "first_visit_date": "2024-01-09 18:45:00"}
    pred, infl = runs.score_with_active_model(spark, root, spark.createDataFrame([record]))
    p = pred.first()
    assert p.prediction in (0, 1) and 0.0 <= p.probability <= 1.0 and p.model_version == "m1"
    rows = infl.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert all(r.feature in feats for r in rows)
    mags = [abs(r.influence) for r in rows]
    assert mags == sorted(mags, reverse=True)


def test_node_table_scores_like_the_forest(spark, trained):
    """Scores and importances over the node table: MLlib's, and those of DuckDB's walk over the same table."""
    import duckdb

    from purchase_signals.operators import forest
    model, prepared, feats, _, _ = trained
    nodes = forest.node_table(spark, model)
    test = prepared.where(F.col("is_test")).select(*KEY, *feats)
    got = {(r.user_id, r.log_ts): r for r in forest.score(nodes, test, feats, KEY).collect()}
    want = {(r.user_id, r.log_ts): r for r in ML.predict(model, test, feats, KEY).collect()}
    assert got.keys() == want.keys() and len(got) == test.count()
    assert all(got[k].probability == pytest.approx(want[k].probability) for k in got)
    assert all(got[k].prediction == want[k].prediction for k in got if abs(want[k].probability - 0.5) > 1e-9)
    imp = {r.feature: r.importance for r in forest.importances(nodes, feats).collect()}
    assert imp == pytest.approx(dict(zip(feats, model.stages[-1].featureImportances.toArray().tolist())))
    table = nodes.toPandas()
    rows = test.select(*KEY, F.array(*[F.col(f"`{f}`").cast("double") for f in feats]).alias("x")).toPandas()
    assert len(table) and len(rows)
    walked = duckdb.sql("""
        WITH RECURSIVE walk AS (
          SELECT r.user_id, r.log_ts, r.x, n.tree, n.node FROM rows r JOIN "table" n ON n.node = 0
          UNION ALL
          SELECT w.user_id, w.log_ts, w.x, w.tree, CAST(CASE WHEN w.x[CAST(n.feature AS BIGINT) + 1] <= n.threshold THEN n.left_child ELSE n.right_child END AS INTEGER)
          FROM walk w JOIN "table" n ON n.tree = w.tree AND n.node = w.node WHERE n.gain IS NOT NULL AND NOT isnan(n.gain))
        SELECT w.user_id, w.log_ts, avg(n.weights[2] / (n.weights[1] + n.weights[2])) AS probability
        FROM walk w JOIN "table" n ON n.tree = w.tree AND n.node = w.node WHERE n.gain IS NULL OR isnan(n.gain) GROUP BY 1, 2""").fetchall()
    assert {(u, t): p for u, t, p in walked} == pytest.approx({k: r.probability for k, r in got.items()})
