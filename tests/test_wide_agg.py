"""Many aggregates in passes of a few (quality.wide_agg) and its users."""

from pyspark.sql import functions as F

from purchase_signals.operators import prepare as P
from purchase_signals.operators import quality as Q
from purchase_signals.operators import score as SC


def test_passes_give_the_same_row(spark):
    df = spark.range(300).select(*[F.when(F.col("id") % (i + 7) != 0, (F.col("id") * (i + 3)) % 97).cast("double").alias(f"c.{i}") for i in range(19)])
    aggs = {f"a{i}": F.avg(f"`c.{i}`") + F.stddev_pop(f"`c.{i}`") for i in range(19)}
    one = Q.wide_agg(df, aggs)
    assert one.columns == list(aggs)
    assert one.collect() == df.agg(*[e.alias(n) for n, e in aggs.items()]).collect()
    # no pass of the finished plan computes them all at once
    assert "stddev_pop" not in one._jdf.queryExecution().executedPlan().toString()


def test_scaler_and_ranks(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, None), (2, 3.0, 5.0, 2.0)], "k int, a double, b double, c double")
    got = {r.k: r for r in P.apply_scaler(df, ["a", "b", "c"]).collect()}
    assert (got[1].a, got[2].a, got[1].b, got[1].c, got[2].c) == (-1.0, 1.0, 0.0, None, 0.0)
    values = spark.createDataFrame([(1, 0.5, -0.5 - 1e-13, None, 0.25)], "k int, b double, a double, c double, d double")
    imp = F.struct(*[F.lit(1.0).alias(c) for c in "abcd"])
    # equal to nine digits: by name; null last
    assert [r.feature for r in SC.feature_influence(values, imp, list("abcd"), ["k"]).orderBy("rank").collect()] == ["a", "b", "d", "c"]
