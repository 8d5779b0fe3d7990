"""Edge rows for the scalar features (FIXTURES.md §5), hand-computed."""

import datetime as dt

import pytest

from purchase_signals import config as C
from purchase_signals.functions import categorical as cat
from purchase_signals.functions import dates, screens
from purchase_signals.functions.hashing import record_hash
from purchase_signals.operators.featurize import featurize


def one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("visit,purchase,label", [
    ("2024-01-01 00:00:00", "2024-01-02 00:00:00", 1),       # exactly 24 h
    ("2024-01-01 00:00:00", "2024-01-02 00:00:00.5", 0),     # just over
    ("2024-01-01 01:00:00", "2024-01-01 00:00:00", 1),       # purchase before visit
    ("2024-01-01 00:00:00", None, 0),
    ("2024-01-01 00:00:00", "garbage", 0),
    ("01/05/2024", "2024-01-05 10:00:00", 1),                # month-first format
])
def test_purchase_label(spark, visit, purchase, label):
    df = one(spark, [(visit, purchase)], "v string, p string")
    got = df.select(dates.purchase_label(dates.parse_date("v"), dates.parse_date("p")).alias("y")).first()["y"]
    assert got == label


def test_weekday_and_weekend(spark):
    df = one(spark, [("2024-01-01",), ("2024-01-06",), (None,)], "v string")
    ts = dates.parse_date("v")
    dow = dates.day_of_week(ts)
    rows = df.select(dow.alias("d"), dates.is_weekend(dow).alias("w"), dates.hour_of_day(ts, serve=True).alias("h"),
                     dates.day_of_week(ts, serve=True).alias("ds")).collect()
    assert [(r.d, r.w) for r in rows] == [(0, 0), (5, 1), (None, 0)]
    assert rows[2].h == C.SERVE_DEFAULT_HOUR and rows[2].ds == C.SERVE_DEFAULT_DAYOFWEEK


def test_screen_features(spark):
    df = one(spark, [("SearchResults",), ("Home,Home,Checkout",), (None,), ("",), ("Home, ,Search",)], "s string")
    out = df.select(*[c.alias(n) for n, c in screens.screen_flags("s").items()],
                    screens.other_screens("s").alias("other"), screens.other_screens("s", serve=True).alias("other_serve"))
    out = out.withColumns(screens.category_counts()).collect()
    assert out[0]["search"] == 1 and out[0]["other"] == 1
    assert out[1]["other"] == 2 and out[1]["cart_count"] == 1 and out[1]["checkout"] == 1
    for r in out[2:4]:
        assert r["other"] == 0 and sum(r[screens.flag_name(s)] for s in C.TRACKED_SCREENS) == 0
    # a blank token counts when training, not when serving
    assert out[4]["other"] == 2 and out[4]["other_serve"] == 1


@pytest.mark.parametrize("v,major,score,serve_major,serve_score", [
    ("3.10.1", 3, 4.01, 3, 4.01),
    ("3", 3, 3.0, 3, 3.0),
    ("x.1", None, None, 3, 3.0),
    (None, None, None, 3, 3.0),
])
def test_version(spark, v, major, score, serve_major, serve_score):
    r = one(spark, [(v,)], "v string").select(
        cat.app_major_version("v").alias("m"), cat.version_score("v").alias("s"),
        cat.app_major_version("v", serve=True).alias("ms"), cat.version_score("v", serve=True).alias("ss")).first()
    assert r.m == major and r.ms == serve_major and r.ss == pytest.approx(serve_score)
    assert (r.s is None and score is None) or r.s == pytest.approx(score)


def test_segment_and_platform(spark):
    df = one(spark, [("Young  Power User", "iOS"), ("Teen", "Web"), (None, None)], "seg string, p string")
    r = df.select(cat.age_group("seg").alias("a"), cat.user_type("seg").alias("u"),
                  cat.user_type("seg", serve=True).alias("us"), cat.age_group("seg", serve=True).alias("as_"),
                  cat.platform_code("p").alias("p"), cat.platform_code("p", serve=True).alias("ps")).collect()
    assert (r[0].a, r[0].u, r[0].p) == ("Young", "Power User", 1)
    assert (r[1].a, r[1].u, r[1].us, r[1].p, r[1].ps) == ("Teen", "", "User", None, 0)
    assert (r[2].as_, r[2].us, r[2].ps) == ("Unknown", "User", 0)


def test_record_hash_normalizes_dates(spark):
    df = one(spark, [(7, " 2024-01-01 "), (7, "2024-01-01 09:30")], "user_id long, first_visit_date string")
    hs = [r.h for r in df.select(record_hash().alias("h")).collect()]
    assert hs == ["8cc5b7c13367b847438c9e75289530e6"] * 2


def test_record_hash_null_keys_do_not_collide(spark):
    df = one(spark, [(None, "2024-01-01"), (1, None)], "user_id long, first_visit_date string")
    hs = [r.h for r in df.select(record_hash().alias("h")).collect()]
    assert len(set(hs)) == 2


def test_unseen_category_is_all_false(spark):
    rows = [(1, "2024-01-01 10:00:00", None, "Home", 1, 1, 0, 0, 0, 30, "iOS", "Mars", "Email", "Young Buyer", "3.1.0", 0,
             dt.datetime(2024, 1, 1, 10))]
    schema = ("user_id long, first_visit_date string, purchase_date string, screen_list string, session_count long, "
              "total_screens_viewed long, used_search_feature int, wrote_review int, added_to_wishlist int, age int, "
              "platform string, region string, acquisition_channel string, user_segment string, app_version string, "
              "made_purchase int, log_ts timestamp_ntz")
    f = featurize(one(spark, rows, schema), C.FIXTURE_VOCABULARY).first().asDict()
    assert not any(v for k, v in f.items() if k.startswith("region_"))
    assert f["channel_email"] is True and f["age_group_young"] is True and f["user_type_buyer"] is True


def test_featurize_never_uses_python_udfs(spark):
    from conftest import SF_SMALL
    from purchase_signals.sources.tables import app_log

    plan = featurize(app_log(spark, SF_SMALL), C.FIXTURE_VOCABULARY)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
