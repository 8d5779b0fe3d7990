"""Categories of the data, identity of scored rows, increments and the key index."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from purchase_signals import config as C
from purchase_signals.operators import ingest as I
from purchase_signals.operators import model as ML
from purchase_signals.operators import score as SC
from purchase_signals.operators.vocab import vocabulary_dict
from purchase_signals.plans import runs
from purchase_signals.sources import files, keyindex, registry, vocabulary
from purchase_signals.sources.tables import app_log


@pytest.fixture(scope="module")
def log(spark):
    return app_log(spark, SF_SMALL).cache()


def root_of():
    return f"{tempfile.mkdtemp(prefix='ps-incr-')}/store"


def other(log):
    """Regions, channels and segments that the test data has not."""
    return log.withColumns({"region": F.concat(F.lit("Sh. "), (F.col("user_id") % 3).cast("string")), "acquisition_channel": F.lit("Poster"),
                            "user_segment": F.concat(F.lit("Kind"), (F.col("user_id") % 2).cast("string"), F.lit(" of  Guest"))})


def test_categories_of_the_data_become_columns(spark, log):
    root = root_of()
    rows = other(log)
    first, second = rows.where("user_id % 3 <> 2"), rows
    runs.ingest_batch(spark, first, root, "a", min_batch=1)
    assert runs.featurize_increment(spark, root, "v1", min_batch=1) == "v1"
    one = files.load_features(spark, root)
    names = {"region_sh_ 0", "region_sh_ 1", "channel_poster", "age_group_kind0", "age_group_kind1", "user_type_of guest"}
    assert names <= set(one.columns) and "region_asia" not in one.columns and "region_sh_ 2" not in one.columns
    assert one.where("`channel_poster` AND `user_type_of guest`").count() == first.count()
    runs.ingest_batch(spark, second, root, "b", min_batch=1)
    assert runs.featurize_increment(spark, root, "v2", min_batch=1) == "v2"
    two = files.load_features(spark, root)
    got = {(r.user_id % 3, r["region_sh_ 2"]) for r in two.select("user_id", "region_sh_ 2").collect()}
    assert got == {(0, False), (1, False), (2, True)}
    assert files.load_features(spark, root, "v1").columns == one.columns
    by_version = vocabulary.load_vocabulary(spark, root).where("processing_version = 'v2'").collect()
    assert [(r.column_name, r.value) for r in by_version] == [("region", "Sh. 2")]
    # a model trained on v2 scores with v2's categories
    small = ML.ForestParams(num_trees=3, max_depth=4)
    assert runs.train_and_promote(spark, root, "m1", params=small, cv=False)["promoted"]
    active = runs.ActiveModel.load(spark, root)
    assert active.vocab == vocabulary_dict(vocabulary.load_vocabulary(spark, root)) and names | {"region_sh_ 2"} <= set(active.features)
    scored = active.inputs(second.limit(50), ["user_id"])
    assert scored.where("`region_sh_ 2` = (user_id % 3 = 2)").count() == 50
    art = {n: spark.read.json(f"{root}/artifacts/m1/{n}").count() for n in ("confusion_matrix", "class_report", "scaler", "features")}
    assert art["features"] == len(active.features) and art["scaler"] == len(active.scaled) and min(art.values()) > 0


def test_values_that_differ_in_case_share_a_column(spark, log):
    from purchase_signals.operators.featurize import featurize

    rows = log.withColumn("region", F.when(F.col("user_id") % 2 == 0, "EMEA").otherwise("emea"))
    out = featurize(rows, {"region": ["EMEA", "emea"]})
    assert out.columns.count("region_emea") == 1 and out.where("NOT region_emea").count() == 0


def test_too_many_categories_are_an_error(spark, log, monkeypatch):
    monkeypatch.setattr(C, "MAX_CATEGORIES", 3)
    root = root_of()
    runs.ingest_batch(spark, log, root, "a", min_batch=1)
    with pytest.raises(ValueError, match="categories"):
        runs.featurize_increment(spark, root, "v1", min_batch=1)
    assert files.load_features(spark, root) is None


def test_every_pending_row_gets_one_prediction(spark, log):
    """Two rows with equal keys, one of them twice, one without a timestamp."""
    root = root_of()
    runs.ingest_batch(spark, log, root, "a", min_batch=1)
    runs.featurize_increment(spark, root, "v1", min_batch=1)
    runs.train_and_promote(spark, root, "m1", params=ML.ForestParams(num_trees=3, max_depth=4), cv=False)
    base = log.orderBy("user_id", "log_ts").limit(2).withColumn("predicted", F.lit(None).cast("boolean"))
    a, b = base.collect()
    rows = spark.createDataFrame([a, {**a.asDict(), "age": 99}, {**a.asDict(), "age": 99}, {**b.asDict(), "log_ts": None}], base.schema)
    assert runs.score_pending(spark, root, rows, "p1") == 4
    assert runs.score_pending(spark, root, rows, "p1") == 4  # a retry
    stored = spark.read.parquet(f"{root}/predictions")
    assert stored.count() == 4 and sorted((r.age, r.occurrence) for r in stored.where(F.col("user_id") == a.user_id).collect()) == sorted(
        [(a.age, 1), (99, 1), (99, 2)] + ([(b.age, 1)] if b.user_id == a.user_id else []))
    assert [r.predicted for r in runs.scored_flags(spark, root, rows).collect()] == [True] * 4
    assert runs.score_pending(spark, root, rows, "p2") == 0
    # one more copy of a scored row: only that one is open
    more = rows.unionByName(rows.where("age = 99").limit(1))
    assert sorted(r.predicted for r in runs.scored_flags(spark, root, more).collect()) == [False] + [True] * 4
    assert runs.score_pending(spark, root, more, "p3") == 1
    got = runs.score_records(spark, root, rows.limit(1).withColumn("age", F.lit(33)).drop("predicted"), "one", "interactive")
    assert [(r.age, r.prediction_source, r.model_version) for r in got.collect()] == [(33, "interactive", "m1")]
    assert spark.read.parquet(f"{root}/predictions").where("prediction_source IS NULL").count() == 5


def test_null_safe_mark(spark):
    df = spark.createDataFrame([(1, None, None), (1, 5, False), (None, 5, None), (2, 1, True)], "a int, b int, predicted boolean")
    done = spark.createDataFrame([(1, None), (None, 5), (None, 5)], "a int, b int")
    got = sorted(((r.a, r.b, r.predicted) for r in SC.mark_scored(df, done, ["a", "b"]).collect()), key=str)
    assert got == sorted([(1, None, True), (1, 5, False), (None, 5, True), (2, 1, True)], key=str)


def test_rows_without_timestamp_get_the_runs(spark, log):
    root = root_of()
    rows = log.withColumn("log_ts", F.when(F.col("user_id") % 2 == 0, F.col("log_ts")))
    runs.ingest_batch(spark, rows, root, "a", min_batch=1)
    stored = files.read_raw(spark, root)
    assert stored.where("log_ts IS NULL").count() == 0 and stored.count() == log.count()
    assert files.read_runs(spark, root, "ingest_runs").first().last_processed_timestamp.year >= 2025
    runs.ingest_batch(spark, log.drop("log_ts").withColumn("first_visit_date", F.lit("2031-01-01")).dropDuplicates(["user_id"]), root, "b", min_batch=1)
    assert files.read_raw(spark, root).where("log_ts IS NULL").count() == 0


def test_an_increment_reads_only_its_own_folders(spark, log):
    root = root_of()
    h = F.pmod(F.xxhash64("user_id", "log_ts"), F.lit(3))
    for k in range(3):
        runs.ingest_batch(spark, log.where(h <= k), root, f"i{k}", min_batch=1)
        earlier = files.read_runs(spark, root)
        todo = runs.unprocessed_log(spark, root, earlier)
        assert todo.select("ingest_run").distinct().collect() == [(f"i{k}",)]
        assert all(f"ingest_run=i{k}/" in f for f in touched(todo))
        runs.featurize_increment(spark, root, f"v{k}", min_batch=1)
    table = files.load_features(spark, root)
    last = {r.processing_version: r for r in files.read_runs(spark, root).collect()}["v2"]
    n, users, rate = table.agg(F.count(F.lit(1)), F.count_distinct("user_id"), F.round(F.avg(C.TARGET), 6)).first()
    assert (last.record_count, last.id_count, last.purchase_rate, last.feature_count) == (n, users, rate, len(table.columns) - 1)
    # the first version wins for every user
    first = table.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n")).first()[0]
    assert first == n <= log.count()


def touched(df):
    """Files that the scan of ``df`` opens, by Spark's own name column."""
    return [r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()]


def test_held_back_batches_are_read_once(spark, log):
    root = root_of()
    few = log.limit(150)
    assert runs.ingest_batch(spark, few, root, "a")["pending"] == 150
    assert runs.ingest_batch(spark, log.where("false"), root, "b")["pending"] == 150  # an empty batch changes nothing
    assert runs.ingest_batch(spark, log, root, "c")["inserted"] == log.count()
    assert files.read_runs(spark, root, "ingest_runs").first().consumed_pending == ["a", "b"]
    assert runs.ingest_batch(spark, few, root, "d") == {"ingest_run": "d", "inserted": 0, "pending": 0}


def test_prefixes_grow_with_a_run():
    most = keyindex.KEYS_PER_FOLDER
    assert [keyindex.digits_of(n) for n in (0, most, most + 1, 16 * most, 16 * most + 1, 16 ** 9 * most)] == [0, 0, 1, 1, 2, keyindex.MAX_DIGITS]


def test_runs_with_prefixes_of_other_lengths(spark, monkeypatch):
    root = root_of()
    monkeypatch.setattr(keyindex, "KEYS_PER_FOLDER", 10)
    keys = [spark.range(a, b).select(F.md5(F.col("id").cast("string")).alias("key")) for a, b in ((0, 5), (5, 105), (105, 1105))]
    for i, k in enumerate(keys):
        keyindex.add_keys(k, root, "k", f"r{i}")
    runs_of = ["r0", "r1", "r2"]
    lengths = {n.split("/p")[0]: len(n.split("/p")[1]) for n in keyindex.folders(keys[0].unionByName(keys[1]).unionByName(keys[2]), root, "k", runs_of)}
    assert lengths == {"r0": 0, "r1": 1, "r2": 2}
    batch = spark.range(0, 1200).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    assert sorted(r.id for r in keyindex.unseen(batch, F.col("h"), root, "k", runs_of).collect()) == list(range(1105, 1200))


def test_key_index_gives_the_rows_of_an_anti_join(spark, monkeypatch):
    root = root_of()
    monkeypatch.setattr(keyindex, "KEYS_PER_FOLDER", 100)  # prefixes of two digits for the 20,000 keys
    old = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("key"))
    keyindex.add_keys(old.where("hex(substring(key, 1, 1)) < '38'"), root, "k", "r1")
    keyindex.add_keys(old.where("hex(substring(key, 1, 1)) >= '38'"), root, "k", "r2")
    keyindex.add_keys(spark.range(7).select(F.md5(F.lit("uncommitted")).alias("key")), root, "k", "r3")
    batch = spark.range(19990, 20300).select("id", F.md5(F.col("id").cast("string")).alias("h")).unionByName(
        spark.createDataFrame([(1, None), (2, None)], "id long, h string"))
    got = keyindex.unseen(batch, F.col("h"), root, "k", ["r1", "r2"])
    assert sorted(r.id for r in got.collect()) == [1, 2, *range(20000, 20300)]
    assert keyindex.unseen(spark.range(1).select(F.md5(F.lit("uncommitted")).alias("h")), F.col("h"), root, "k", ["r1", "r2"]).count() == 1
    # few keys open few folders, known ones each their own
    new = spark.range(10**6, 10**6 + 20).select(F.md5(F.col("id").cast("string")).alias("key"))
    assert len(keyindex.folders(new, root, "k", ["r1", "r2"])) <= 4
    known = old.limit(5)
    names = keyindex.folders(known, root, "k", ["r1", "r2"])
    assert {r.key[:2] for r in known.collect()} <= {n.split("/p")[1] for n in names} and len(names) <= 7
    found = keyindex.candidates(known, root, "k", ["r1", "r2"])
    assert len(touched(found)) == len(names)
    assert keyindex.unseen(batch, F.col("h"), root_of(), "k", []).count() == batch.count()
    # a run written again replaces its keys
    keyindex.add_keys(old.limit(1), root, "k", "r2")
    assert keyindex.candidates(old, root, "k", ["r2"]).count() == 1


def test_stores_without_an_index_get_one(spark, log):
    """Runs that were stored before there was an index are indexed first."""
    root = root_of()
    rows = I.with_record_hash(log).withColumn("ingest_run", F.lit("old"))
    rows.write.partitionBy("ingest_run").parquet(f"{root}/raw_log")
    run = spark.createDataFrame([("old", None, None, None, rows.count(), [], [])], T.StructType(files.INGEST_RUNS_SCHEMA.fields[:-1]))
    files.write_run(run, root, "old", "ingest_runs")
    assert runs.ingest_batch(spark, log, root, "new", min_batch=1)["inserted"] == 0
