"""Promotions as state: equal to a plain fold over all models, and resumed from a stored promotion."""

import datetime as dt
import tempfile

from purchase_signals import config as C
from purchase_signals.operators import decisions as D
from purchase_signals.sources import registry

START = dt.datetime(2024, 1, 1)
SCHEMA = "model_version string, trained_at timestamp_ntz, test_f1 double"


def models(n=120):
    """Scores that rise and fall, ties in time, and models without a score."""
    scores = [None if i % 17 == 3 else float("nan") if i % 23 == 5 else ((i * 37) % 101) / 400 + i / 200 for i in range(n)]
    return [(f"m{i:03d}", START + dt.timedelta(hours=i // 2), s) for i, s in enumerate(scores)]


def replay(rows):
    score, version, out = 0.0, None, {}
    for name, _, f1 in sorted(rows, key=lambda r: (r[1], r[0])):
        better = f1 is not None and f1 - score > C.MIN_F1_IMPROVEMENT
        out[name] = (score, version, better)
        if better:
            score, version = f1, name
    return out


def history(df, **since):
    return {r.model_version: (r.production_f1, r.production_version, bool(r.promoted)) for r in D.promotion_history(df, **since).collect()}


def test_history_equals_a_fold(spark):
    rows = models()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = replay(rows)
    assert history(df) == want and sum(w[2] for w in want.values()) > 5
    plan = D.promotion_history(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan and "Exchange" not in plan
    # from a stored promotion only the candidates behind it, with the same decisions
    first = D.promotions(df)[2]
    rest = history(df, since=first)
    assert rest == {k: v for k, v in want.items() if k in rest} and len(rest) == len(rows) - 1 - int(first.model_version[1:])
    assert D.promotions(spark.createDataFrame([], SCHEMA)) == [] and history(spark.createDataFrame([], SCHEMA)) == {}


def test_registry_goes_on_from_the_last_promotion(spark):
    root = f"{tempfile.mkdtemp(prefix='ps-prom-')}/store"
    rows = models(60)
    want = replay(rows)

    def add(part):
        table = [(v, t, "v1", {"test_f1_score": s} if s is not None else {}, "", [], []) for v, t, s in part]
        spark.createDataFrame(table, registry.MODELS_SCHEMA).write.mode("append").parquet(f"{root}/models")

    assert registry.promote_since(spark, f"{root}/none") == []
    add(rows[:31])
    got = registry.promote_since(spark, root)
    assert registry.promote_since(spark, root) == []
    add(rows[31:])
    got += registry.promote_since(spark, root)
    assert got == [v for v, w in want.items() if w[2]]
    last = registry.active_version(spark, root).first()
    assert (last.model_version, last.score) == (got[-1], dict((v, s) for v, _, s in rows)[got[-1]])
    # a promotion stored without its score asks the model's row
    old = spark.createDataFrame([(got[-1], dt.datetime(2100, 1, 1))], "model_version string, promoted_at timestamp_ntz")
    old.write.mode("append").parquet(f"{root}/promotions")
    assert registry.production(spark, root) == D.Production(last.score, last.model_version, last.trained_at)
    assert not registry.promote_if_better(spark, root, rows[0][0])


def test_previous_crosses_partitions(spark):
    rows = [(i, None if i % 7 == 2 else i / 10) for i in range(40)]
    df = spark.createDataFrame(rows, "t int, v double").repartition(4)
    # small partitions are not put together, so there are edges to cross
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed, before = D.previous(df, "t", "v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r.t: r.b for r in placed.select("t", before.alias("b")).collect()}
    assert placed.select("_part").distinct().count() > 1
    assert got == {t: (rows[t - 1][1] if t else None) for t, _ in rows}
