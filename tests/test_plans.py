"""Physical-plan properties and behaviour under a hot key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from purchase_signals import config as C
from purchase_signals.operators import ingest as I
from purchase_signals.operators import merge as M
from purchase_signals.functions import screens
from purchase_signals.operators.featurize import featurize
from purchase_signals.sources.tables import _screen_expr, app_log, visits_from_events

ORACLE_QUERIES = sorted(E.oracle_sql())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ORACLE_QUERIES)
def test_no_python_in_plans(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "FlatMapGroupsInPandas" not in plan


def test_events_scan_is_pruned(spark):
    plan = app_log(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line][0]
    schema = scan[scan.index("ReadSchema"):]
    assert "props" not in schema and "value" not in schema
    assert all(c in schema for c in ("event_id", "ts", "user_id", "event_type"))


def test_app_log_aggregations_are_partial(spark):
    plan = plan_of(app_log(spark, SF_SMALL))
    assert "partial_collect_list" in plan and "partial_sum" in plan and "partial_min" in plan


def test_features_gather_no_lists(spark):
    for name in ("features", "purchase_rate_by_region"):
        assert "collect_list" not in plan_of(E.queries()[name](spark, SF_SMALL))


def test_hot_user_hour_is_combined_before_the_shuffle(spark):
    """A third of the events lie in one user's hour: the list is whole and in
    order, and the state gives the same features."""
    t0 = dt.datetime(2024, 1, 1, 10)
    kinds = ["view", "click", "signup", "error", "purchase", None]
    rows = [(i, t0 + dt.timedelta(milliseconds=700 * (i % 5000)), 1, kinds[i % 6]) for i in range(6000)]
    rows += [(10_000 + i, t0 + dt.timedelta(minutes=37 * i), 2 + i % 40, kinds[i % 5]) for i in range(12000)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").repartition(16)
    lists, state = visits_from_events(ev), visits_from_events(ev, lists=False)
    hot = lists.where("user_id = 1").first()
    named = {r.event_id: r.screen for r in ev.withColumn("screen", _screen_expr()).where("user_id = 1").collect()}
    order = sorted((r for r in rows if r[2] == 1 and named[r[0]]), key=lambda r: (r[1], r[0]))
    assert hot.screen_list == ",".join(named[r[0]] for r in order) and hot.session_count == 6000
    for mode in ("train", "serve"):
        a, b = (featurize(v, C.FIXTURE_VOCABULARY, mode).drop("d", "day_purchase_ts", "purchase_ts") for v in (lists, state))
        assert sorted(a.columns) == sorted(b.columns) and a.count() == b.count() > 40
        assert a.exceptAll(b.select(a.columns)).isEmpty()


def test_screen_state_equals_the_list(spark):
    names = [[], [""], [" "], ["SearchResults", "Home", "Home"], ["xCheckoutx", " ", "Search"], [None, "Account"], ["a,Checkout", "b"]]
    rows = [(i, s) for i, group in enumerate(names) for s in group]
    merged = spark.createDataFrame(rows, "i long, s string").select("i", *[e.alias(c) for c, e in screens.screen_state("s").items()])
    merged = merged.groupBy("i").agg(F.bit_or(screens.SEEN).alias(screens.SEEN), *[F.sum(c).alias(c) for c in screens.STATE[1:]])
    lists = spark.createDataFrame([(i, ",".join(s for s in g if s is not None)) for i, g in enumerate(names)], "i long, screen_list string")
    for serve in (False, True):
        state = lists.join(merged, "i", "left").select("i", screens.others_of_state(serve).alias("n"), *[e.alias(c) for c, e in screens.flags_of_state().items()])
        want = lists.select("i", screens.other_screens("screen_list", serve).alias("n"), *[e.alias(c) for c, e in screens.screen_flags("screen_list").items()])
        assert sorted(state.collect()) == sorted(want.collect())


def test_hot_hash_reduction(spark):
    """A third of the rows share one hash: one row survives, the latest."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", i, t0 + dt.timedelta(seconds=i)) for i in range(3000)]
    rows += [(f"k{i}", i, t0) for i in range(6000)]
    df = spark.createDataFrame(rows, "record_hash string, v int, log_ts timestamp_ntz").repartition(16)
    out = I.reduce_by_hash(df)
    assert out.count() == 6001
    assert out.where(F.col("record_hash") == "hot").first()["v"] == 2999
    stored = spark.createDataFrame([("hot",), ("k1",)], "record_hash string")
    assert I.new_records(df, stored).count() == 5999


def test_hot_user_merge(spark):
    """Existing table where one user holds a third of the rows."""
    old = spark.createDataFrame([(1, i) for i in range(3000)] + [(u, 0) for u in range(2, 6002)], "user_id long, v int")
    new = spark.createDataFrame([(1, -1)] * 500 + [(u, -1) for u in range(6000, 6100)], "user_id long, v int")
    merged = M.merge_existing_wins(old, new)
    assert merged.count() == 9000 + 98
    assert merged.where((F.col("user_id") == 1) & (F.col("v") == -1)).count() == 0


@pytest.mark.parametrize("mode", ["train", "serve"])
def test_featurize_is_fully_codegen(spark, mode):
    from purchase_signals.operators.featurize import featurize
    from purchase_signals.plans.catalog import log_table

    plan = plan_of(featurize(log_table(spark, SF_SMALL), C.FIXTURE_VOCABULARY, mode=mode))
    ops = [line.strip(" :+-") for line in plan.splitlines() if line.strip(" :+-")]
    # the sum over a version's parts, however many, is a lambda: its projection is
    # generated code too, but on its own
    rest = [op for op in ops if not op.startswith(("*(", "FileScan"))]
    assert ops and len(rest) <= 1 and all(op.startswith("Project [") for op in rest), rest


def test_every_version_part_counts(spark):
    from purchase_signals.functions import categorical as cat

    parts = ["1"] * 17 + ["4", "x"]
    rows = [(".".join(parts[:n]),) for n in (1, 16, 17, 18)] + [(".".join(parts),), ("",)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "v string").select(
        cat.version_score("v").alias("s"), cat.version_score("v", serve=True).alias("ss")).collect()]
    want = [sum(float(p) / 10 ** n for n, p in enumerate(parts[:k])) for k in (1, 16, 17, 18)]
    assert [g[0] for g in got[:4]] == pytest.approx(want)
    assert got[4:] == [(None, 3.0), (None, 3.0)]


def test_stores_are_scanned_by_column(spark):
    from purchase_signals.plans.catalog import QUERIES, split_rows

    plan = plan_of(QUERIES["hash_keys"](spark, SF_SMALL))
    assert "FileScan parquet" in plan and "ReadSchema: struct<user_id:bigint,first_visit_date:string>" in plan
    assert split_rows(spark, SF_SMALL) is split_rows(spark, SF_SMALL)


def test_split_and_weights_do_not_shuffle_rows_on_the_label(spark):
    from purchase_signals.operators import model as ML
    from purchase_signals.operators import prepare as P
    from purchase_signals.plans.catalog import features

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        f = features(spark, SF_SMALL)
        for df in (P.stratified_split(f, ["user_id", "log_ts"]), ML.with_class_weights(f)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            main = plan.split("Subqueries")[0]
            assert "Exchange" not in main.split("Subquery")[0] and "SortMergeJoin" not in main.split("Subquery")[0], main[:1500]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

