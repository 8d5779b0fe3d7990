"""The app log's shuffles and the reduction of a batch by hash."""

from conftest import SF_SMALL
from purchase_signals.operators import ingest as I
from purchase_signals.sources.tables import read_table, visits_from_events


def test_app_log_is_dealt_twice(spark):
    plan = visits_from_events(read_table(spark, SF_SMALL, "events"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    # a running minimum, not one over the rest of the user's days for each day
    assert "unboundedfollowing" not in plan.lower()


def test_reduction_carries_a_row_once(spark):
    rows = spark.createDataFrame([("h", 2, "a"), ("h", 2, "b"), ("h", None, "z"), ("g", None, None), (None, 1, "n")], "record_hash string, log_ts int, x string")
    out = I.reduce_by_hash(rows)
    assert sorted(out.collect(), key=str) == sorted([("h", 2, "b"), ("g", None, None), (None, 1, "n")], key=str)
    assert "max_by" not in out._jdf.queryExecution().executedPlan().toString()
