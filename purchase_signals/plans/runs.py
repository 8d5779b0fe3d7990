"""Run-level jobs over a store root: ingest, incremental featurize, score.

Each is a handful of Spark actions over lazy plans; gates and decisions read
one aggregate row. Used by the streaming jobs' ``foreachBatch`` too.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import ingest as I
from ..operators import metrics as MT
from ..operators import score as SC
from ..operators.featurize import featurize
from ..session import stored
from ..sources import files, keyindex, registry, vocabulary


def run_id(prefix: str, now: dt.datetime | None = None, sep: str = "_") -> str:
    """``<prefix><sep><yyyymmdd_HHMMSS>_<8 hex>`` computed once on the driver
    and used as a literal (F21): ``rf_…``, ``pred_…``; feature versions use
    ``run_id("retail_v", sep="")``."""
    now = now or dt.datetime.now()
    stamp = now.strftime("%Y%m%d_%H%M%S")
    return f"{prefix}{sep}{stamp}_{hashlib.md5(f'{prefix}{now.isoformat()}'.encode()).hexdigest()[:8]}"


def ingest_batch(spark: SparkSession, batch: DataFrame, root: str, ingest_run: str,
                 min_batch: int = C.MIN_INGEST_BATCH, source: str | None = None, now: dt.datetime | None = None) -> dict:
    """Hash, drop stored hashes, reduce duplicates, gate, append (J1, S6, P2),
    then write the run row (S11).

    Rows without a timestamp get the run's (P4). Stored hashes are looked up in
    the key index, which reads only the folders that may hold one of the batch's.
    A batch with fewer than ``min_batch`` new rows is held back: its rows wait in
    ``pending_log`` and join the next batch, so a caller that hands every row
    over once loses none; batches that have joined are not read again. What this
    run id wrote before does not count as stored or pending, so a retried run
    gives the same result again.
    """
    now = now or dt.datetime.now()
    # one entry for each earlier run and each batch held back
    earlier = files.read_runs(spark, root, "ingest_runs").where(F.col("run_id") != F.lit(ingest_run)).select("run_id", "consumed_pending").collect()
    used = {p for r in earlier for p in r.consumed_pending or []}
    held = sorted(r.run_id for r in files.read_runs(spark, root, "pending_runs").select("run_id").collect() if r.run_id not in used | {ingest_run})
    waiting = files.read_or_empty(spark, f"{root}/pending_log", files.STORED_LOG_SCHEMA).where(F.col("ingest_run").isin(held))
    hashed = I.with_record_hash(I.with_default_timestamp(batch, now))
    have = set(hashed.columns)
    rows_now = hashed.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in files.STORED_LOG_SCHEMA.fields[:-1]])
    runs = [r.run_id for r in earlier]
    for run in sorted(set(runs) - keyindex.indexed_runs(spark, root, "log_keys")):
        old = files.read_or_empty(spark, f"{root}/raw_log", files.STORED_LOG_SCHEMA).where(F.col("ingest_run") == F.lit(run))
        keyindex.add_keys(old.select(F.col("record_hash").alias("key")), root, "log_keys", run)
    reduced = stored(I.reduce_by_hash(rows_now.unionByName(waiting.drop("ingest_run"))), "reduced")
    # all that ``fresh`` reads lies in files: its counts and keys are narrow scans, its rows are written once
    fresh = keyindex.unseen(reduced, F.col("record_hash"), root, "log_keys", runs)
    facts = fresh.agg(F.count(F.lit(1)).alias("n"), F.max("log_ts").alias("last")).first()
    if facts.n < max(1, min_batch):
        if facts.n:
            files.overwrite_partition(rows_now, f"{root}/pending_log", "ingest_run", ingest_run)
            pending = files.read_or_empty(spark, f"{root}/pending_log", files.STORED_LOG_SCHEMA).where(F.col("ingest_run") == F.lit(ingest_run))
            row = spark.createDataFrame([(ingest_run, pending.count())], T.StructType(files.PENDING_RUNS_SCHEMA.fields[:-1]))
            files.write_run(row, root, ingest_run, "pending_runs")
        return {"ingest_run": ingest_run, "inserted": 0, "pending": facts.n}
    files.overwrite_partition(fresh, f"{root}/raw_log", "ingest_run", ingest_run)
    added = files.read_or_empty(spark, f"{root}/raw_log", files.STORED_LOG_SCHEMA).where(F.col("ingest_run") == F.lit(ingest_run))
    keyindex.add_keys(added.select(F.col("record_hash").alias("key")), root, "log_keys", ingest_run)
    sample = [r.record_hash for r in added.select("record_hash").orderBy("record_hash").limit(5).collect()]
    row = [(ingest_run, source, now, facts["last"], facts.n, sample, held)]
    schema = T.StructType(files.INGEST_RUNS_SCHEMA.fields[:-1])
    files.write_run(spark.createDataFrame(row, schema), root, ingest_run, "ingest_runs")
    return {"ingest_run": ingest_run, "inserted": facts.n, "pending": 0}


def unprocessed_log(spark: SparkSession, root: str, earlier: DataFrame) -> DataFrame:
    """Rows of the ingest runs that no feature run of ``earlier`` names, read
    through a literal partition filter, so no other folder is opened. The run
    table lists what is stored; a log written without one is listed by folder."""
    done = earlier.select(F.explode("ingest_runs").alias("run_id"))
    committed = files.read_runs(spark, root, "ingest_runs").select("run_id")
    log = files.read_or_empty(spark, f"{root}/raw_log", files.STORED_LOG_SCHEMA)
    if committed.isEmpty():
        committed = log.select(F.col("ingest_run").alias("run_id")).distinct()
    todo = [r.run_id for r in committed.join(done, "run_id", "left_anti").collect()]  # one entry for each new run
    return log.where(F.col("ingest_run").isin(todo))


def featurize_increment(spark: SparkSession, root: str, version: str, new_rows: DataFrame | None = None,
                        min_batch: int = C.MIN_FEATURIZE_BATCH, key: list[str] | None = None) -> str | None:
    """Featurize the stored rows that no committed version has processed,
    merge with the latest version (existing wins), write what is new as
    ``version``, then its run row (the commit). Returns the version, or None
    when the gate holds the rows back; they are still there for the next run.

    Only the new ingest runs' folders are read: which keys are known is asked of
    the key index, and the run's counts are the last run's plus those of the
    rows added. Categories not seen before enter the vocabulary and become
    columns of this version, false in the rows of older ones.

    A run row names the ingest runs it processed, so a row is processed once
    however late it arrives or old it is. Explicit ``new_rows`` are taken as they
    are. The mark ``last_processed_timestamp`` is that of the rows processed,
    known users or not; ``new_record_count`` counts the rows added.
    """
    earlier = files.read_runs(spark, root).where(F.col("processing_version") != F.lit(version))
    if new_rows is None:
        todo = unprocessed_log(spark, root, earlier)  # the folders of the runs, nothing to be stored again
    else:
        todo = new_rows.withColumn("ingest_run", F.lit(None).cast("string")) if "ingest_run" not in new_rows.columns else new_rows
        todo = stored(todo, "todo")
    facts = todo.agg(F.count(F.lit(1)).alias("n"), F.max("log_ts").alias("mark"), F.collect_set("ingest_run").alias("runs")).first()
    if facts.n < max(1, min_batch):
        return None
    vocab = vocabulary.grow(spark, root, version, todo)
    feats = featurize(todo.drop("ingest_run"), vocab)
    key = key or ["user_id"]
    known = [r.processing_version for r in earlier.select("processing_version").collect()]  # one entry for each run
    for old in sorted(set(known) - keyindex.indexed_runs(spark, root, "feature_keys")):
        rows = spark.read.parquet(f"{root}/features").where(F.col("processing_version") == F.lit(old))
        keyindex.add_keys(rows.select(keyindex.key_hash(key).alias("key")), root, "feature_keys", old)
    # existing wins: only rows of unseen keys are added; they are featurized and written once, what follows reads the version's files
    delta = files.write_feature_version(keyindex.unseen(feats, keyindex.key_hash(key), root, "feature_keys", known), root, version)
    keyindex.add_keys(delta.select(keyindex.key_hash(key).alias("key")), root, "feature_keys", version)
    if key != ["user_id"]:
        users = keyindex.unseen(delta.select("user_id").distinct(), keyindex.key_hash(["user_id"]), root, "feature_users", known)
        users = stored(users, "users")
        keyindex.add_keys(users.select(keyindex.key_hash(["user_id"]).alias("key")), root, "feature_users", version)
    else:
        users = delta
    columns = files.feature_schema(earlier)
    width = len(dict.fromkeys([*(columns.names if columns else []), *delta.columns]))
    added = run_counts(delta)
    added["id_count"] = users.select(F.count_distinct("user_id")).first()[0]
    total = {name: n + last_counts(spark, root, earlier, version).get(name, 0) for name, n in added.items()}
    rate = round(total["label_sum"] / total["label_count"], 6) if total["label_count"] else None
    row = (version, dt.datetime.now(), total["record_count"], added["record_count"], total["id_count"], rate, width, facts.mark, "retail",
           sorted(facts.runs), total["label_sum"], total["label_count"], delta.schema.json())
    files.write_run(spark.createDataFrame([row], T.StructType(files.FEATURE_RUNS_SCHEMA.fields[:-1])), root, version)
    return version


def run_counts(rows: DataFrame) -> dict[str, int]:
    """Counts of a feature table that add up over its parts."""
    label = F.col(C.TARGET) if C.TARGET in rows.columns else F.lit(None).cast("int")
    one = rows.agg(F.count(F.lit(1)).alias("record_count"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("label_sum"),
                   F.count(label).alias("label_count")).first()
    return one.asDict()


def last_counts(spark: SparkSession, root: str, earlier: DataFrame, version: str) -> dict[str, int]:
    """The counts of the last committed run, {} before the first; of a run row
    without them (an older store) the table is counted once."""
    names = ["record_count", "label_sum", "label_count", "id_count"]
    last = earlier.select(F.max_by(F.struct(*names), "processed_at").alias("r")).select("r.*").first()
    if last is None or last.record_count is None:
        return {}
    if last.label_count is None:
        table = files.load_features(spark, root, without=version)
        return run_counts(table) | {"id_count": table.select(F.count_distinct("user_id")).first()[0]}
    return last.asDict()


def committed_predictions(spark: SparkSession, root: str, without: str | None = None) -> DataFrame:
    """``row_id`` of every prediction of a committed run."""
    runs = files.read_runs(spark, root, "prediction_runs").where(F.col("prediction_id") != F.lit(without or ""))
    if runs.isEmpty():
        return spark.createDataFrame([], "row_id string")
    return spark.read.parquet(f"{root}/predictions").join(runs.select("prediction_id"), "prediction_id", "left_semi").select("row_id")


def write_predictions(spark: SparkSession, root: str, scored: DataFrame, prediction_id: str, model_version: str,
                      source: str | None = None) -> int:
    """Scored rows with their input columns, one for each copy, as partition
    ``prediction_id``, then the run row (S8, S9, A14). Returns the rows written."""
    out = SC.occurrences(scored).withColumns({
        "model_version": F.lit(model_version), "prediction_timestamp": F.localtimestamp(), "prediction_source": F.lit(source).cast("string")})
    out = stored(out, "scored")
    files.overwrite_partition(out, f"{root}/predictions", "prediction_id", prediction_id)
    run = out.agg(F.count(F.lit(1)).alias("record_count"), F.round(F.avg("prediction"), 6).alias("positive_rate")).select(
        F.lit(prediction_id).alias("prediction_id"), F.lit(model_version).alias("model_version"), F.localtimestamp().alias("processed_at"),
        "record_count", "positive_rate")
    files.write_run(run, root, prediction_id, "prediction_runs")
    return out.count()


def score_pending(spark: SparkSession, root: str, to_score: DataFrame, prediction_id: str, source: str | None = None) -> int:
    """Batch scoring (M12, S5, S8, S10): every row that is neither flagged nor
    scored by a committed run is scored with the registry's active model and
    written with its input columns; rows with equal or null keys are rows of
    their own. The committed predictions are the scored mark: ``scored_flags``
    shows it on the input. ``source`` tags interactive scoring (S9)."""
    pending = stored(SC.pending_copies(to_score, committed_predictions(spark, root, prediction_id)), "pending")
    if pending.isEmpty():
        return 0
    active = ActiveModel.load(spark, root)
    return write_predictions(spark, root, active.scored(pending), prediction_id, active.version, source)


def score_records(spark: SparkSession, root: str, records: DataFrame, prediction_id: str, source: str = "interactive") -> DataFrame:
    """Interactive scoring (S9): the records are scored, stored with their source
    tag and given back."""
    flagged = records if "predicted" in records.columns else records.withColumn("predicted", F.lit(None).cast("boolean"))
    score_pending(spark, root, flagged, prediction_id, source)
    rows = spark.read.parquet(f"{root}/predictions") if not files.read_runs(spark, root, "prediction_runs").isEmpty() else None
    return rows.where(F.col("prediction_id") == F.lit(prediction_id)) if rows is not None else spark.createDataFrame([], "prediction_id string")


def scored_flags(spark: SparkSession, root: str, to_score: DataFrame, without: str | None = None) -> DataFrame:
    """``to_score`` with ``predicted`` true for every row (copy) that a committed
    run has scored (S10, J3)."""
    return SC.mark_rows(to_score, committed_predictions(spark, root, without))


def train_and_promote(spark: SparkSession, root: str, version: str, params=None, cv: bool = True) -> dict | None:
    """Batch training (M7, M3, M2, M9): retrain decision -> prepare -> cross-
    validate -> fit -> evaluate -> artifacts -> register -> promote. Returns
    the metrics and whether the model was promoted, or None when no training
    is due."""
    from ..operators import model as ML
    from ..operators import prepare as P

    feats_all = files.load_features(spark, root)
    if feats_all is None:
        raise LookupError("no committed feature version")
    active = registry.active_version(spark, root).first()
    if active is not None:
        trained = registry.read_models(spark, root).where(F.col("model_version") == active.model_version).select(F.max("trained_at")).first()[0]
        since = files.read_runs(spark, root).where(F.col("processed_at") > F.lit(trained)).agg(F.coalesce(F.sum("new_record_count"), F.lit(0))).first()[0]
        if (dt.datetime.now() - trained).days <= C.MAX_MODEL_AGE_DAYS and since < C.MIN_NEW_RECORDS_FOR_TRAINING:
            return None
    data_version = feats_all.select(F.max("processing_version")).first()[0]
    key = ["user_id", "log_ts"]
    prepared, feats, nums, scaler = P.prepare_training(feats_all.drop("processing_version"), key)
    prepared = stored(prepared, "prepared")  # one frame for cross-validation and the fit
    train, test = prepared.where(~F.col("is_test")), prepared.where(F.col("is_test"))
    metrics = {}
    if cv:
        folds = ML.cross_validate(spark, train, feats, key, params=params)
        files.write_json(folds, f"{root}/artifacts/{version}/cross_validation")
        metrics = {f"cv_{r.fold}_f1": r.weighted_f1 for r in folds.where("fold IN ('mean', 'std')").collect()}
    model = ML.train_forest(train, feats, C.TARGET, params)
    held = stored(ML.predict(model, test, feats, [C.TARGET]), "held")
    result = ML.evaluate(held)
    metrics |= {f"test_{'f1_score' if k == 'f1' else k}": float(v) for k, v in result.first().asDict().items() if isinstance(v, (int, float))}
    files.write_json(ML.importances(spark, model, feats, top=None), f"{root}/artifacts/{version}/importances")
    files.write_json(result, f"{root}/artifacts/{version}/metrics")
    files.write_json(MT.confusion_matrix(held, C.TARGET, "prediction"), f"{root}/artifacts/{version}/confusion_matrix")
    files.write_json(MT.class_report(held, C.TARGET, "prediction"), f"{root}/artifacts/{version}/class_report")
    files.write_json(scaler, f"{root}/artifacts/{version}/scaler")
    names = spark.createDataFrame([(i, f, f in set(nums)) for i, f in enumerate(feats)], "position int, feature string, scaled boolean")
    files.write_json(names, f"{root}/artifacts/{version}/features")
    vocab = vocabulary.load_vocabulary(spark, root, data_version)
    registry.register_model(spark, root, model, version, data_version, metrics, feats, nums, scaler, vocab=vocab)
    return metrics | {"promoted": registry.promote_if_better(spark, root, version)}


@dataclass
class ActiveModel:
    """A model with what it takes to score raw rows: serving features by the
    model's own vocabulary -> model columns -> stored scaler -> forest."""
    version: str
    model: PipelineModel
    features: list[str]
    scaler: DataFrame
    scaled: list[str]
    vocab: dict[str, list[str]]

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> ActiveModel:
        model, feats, scaler, scaled, version = registry.load_active_model(spark, root)
        return cls(version, model, feats, scaler, scaled, vocabulary.model_vocabulary(spark, root, version))

    def inputs(self, records: DataFrame, keep: list[str]) -> DataFrame:
        """The vectors that ``records`` are scored on, beside the columns ``keep``."""
        from ..operators import prepare as P

        served = featurize(records, self.vocab, mode="serve")
        return P.apply_scaler_table(P.align_features(served, self.features, tuple(keep)), self.scaler, self.scaled)

    def scored(self, records: DataFrame) -> DataFrame:
        """``records`` with all their columns, prediction and probability, row by
        row: the input travels along in a struct and is joined to nothing."""
        from ..operators import model as ML

        whole = records.select(*records.columns, F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("_input"))
        pred = ML.predict(self.model, self.inputs(whole, ["_input"]), self.features, ["_input"])
        return pred.select("_input.*", "prediction", "probability")


def score_with_active_model(spark: SparkSession, root: str, records: DataFrame, key: list[str] | None = None):
    """Score raw records (one or many) with the registry's active model
    (M12, M13, T5), and each row's top influences from the forest's importances.
    Returns (predictions, influences)."""
    from ..operators import model as ML

    key = key or ["user_id"]
    active = ActiveModel.load(spark, root)
    x = active.inputs(records, key)
    pred = ML.predict(active.model, x, active.features, key).withColumn("model_version", F.lit(active.version))
    # one weight per model feature (bounded by the model width)
    weights = active.model.stages[-1].featureImportances.toArray().tolist()
    imp = F.struct(*[F.lit(float(w)).alias(f) for f, w in zip(active.features, weights)])
    return pred, SC.feature_influence(x, imp, active.features, key)
