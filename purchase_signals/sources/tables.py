"""Table scans (S2, S3) and the derived app-log view.

The app log is the pipeline's raw input: one row per user and day, carrying
the comma-joined screen list. It is derived from ``events`` ⋈ ``customer`` ⋈
``nation`` ⋈ ``region`` (see FIXTURES.md, which also gives the DuckDB twin).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import screens

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table (S2). Column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-only projection scan (S3)."""
    from ..operators.ingest import with_record_hash

    return with_record_hash(app_log(spark, sf_dir)).select("record_hash")


def _screen_expr() -> F.Column:
    """Screen name of an event (fixed mapping of the fixture)."""
    eid = F.col("event_id")
    et = F.col("event_type")
    view = (F.when(eid % 4 == 0, "ProductList").when(eid % 4 == 1, "ProductDetail")
            .when(eid % 4 == 2, "Search").otherwise("SearchResults"))
    click = (F.when(eid % 5 == 0, "ShoppingCart").when(eid % 5 == 1, "Checkout")
             .when(eid % 5 == 2, "WishList").when(eid % 5 == 3, "Reviews").otherwise("Promotions"))
    signup = F.when(eid % 3 == 0, "Account").when(eid % 3 == 1, "AddressBook").otherwise("CategoryBrowse")
    return (F.when(et == "view", view).when(et == "click", click)
            .when(et == "signup", signup).when(et == "error", F.lit("Home")))


def _ordered_join(items: F.Column, value: str) -> F.Column:
    """Comma-join the ``value`` field of an array of structs, in the order of
    the structs (their leading fields)."""
    return F.array_join(F.sort_array(items).getField(value), ",")


def _counters(screen_state: bool) -> dict[str, tuple[F.Column, str]]:
    """Per event, what a visit's counters are made of, and how parts are merged."""
    is_purchase = F.col("event_type") == "purchase"
    out = {
        "session_count": (F.lit(1).cast("long"), "sum"),
        "total_screens_viewed": (F.when(is_purchase, 0).otherwise(1).cast("long"), "sum"),
        "used_search_feature": (F.when(F.col("screen") == "Search", 1).otherwise(0), "max"),
        "wrote_review": (F.when(F.col("screen") == "Reviews", 1).otherwise(0), "max"),
        "added_to_wishlist": (F.when(F.col("screen") == "WishList", 1).otherwise(0), "max"),
        "first_visit_ts": (F.col("ts"), "min"),
        "day_purchase_ts": (F.when(is_purchase, F.col("ts")), "min"),
    }
    if screen_state:
        out |= {c: (e, "bit_or" if c == screens.SEEN else "sum") for c, e in screens.screen_state("screen").items()}
    return out


def _merge(df: DataFrame, keys: list[str], how: dict[str, str], *more: F.Column) -> DataFrame:
    return df.groupBy(*keys).agg(*more, *[getattr(F, fn)(c).alias(c) for c, fn in how.items()])


def visits_from_events(events: DataFrame, lists: bool = True) -> DataFrame:
    """Per (user, day): first visit, counters, and the screens.

    Without ``lists`` the screens are mergeable state (a bit set and two
    counts): one aggregation, all of it combined map-side, so a user-hour with
    any number of events is one row per task and nothing is gathered.  With
    ``lists`` they are the ordered screen list, joined in pieces by minute and
    day, so a hot hour is sorted and joined by up to 60 tasks and a day joins at
    most 1,440 pieces.  The pieces are dealt by user, which also serves the
    window and the join with customers: two shuffles from events to the log.
    """
    ev = events.select("event_id", "ts", "user_id", "event_type", F.to_date("ts").alias("d"), _screen_expr().alias("screen"))
    made = _counters(screen_state=not lists)
    how = {c: fn for c, (_, fn) in made.items()}
    ev = ev.withColumns({c: e for c, (e, _) in made.items()})
    if lists:
        ev = ev.withColumn("mi", F.hour("ts") * 60 + F.minute("ts"))
        piece = F.when(F.col("screen").isNotNull(), F.struct("ts", "event_id", "screen"))
        parts = _merge(ev, ["user_id", "d", "mi"], how, _ordered_join(F.collect_list(piece), "screen").alias("part"))
        piece = F.when(F.col("part") != "", F.struct("mi", "part"))
        daily = _merge(parts.repartition("user_id"), ["user_id", "d"], how, _ordered_join(F.collect_list(piece), "part").alias("screen_list"))
    else:
        daily = _merge(ev, ["user_id", "d"], how)
    # Rows per user are bounded by the number of days, whatever the skew; from the
    # last day back the minimum is carried along.
    later = Window.partitionBy("user_id").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("purchase_ts", F.min("day_purchase_ts").over(later))


def app_log_from(events: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame, lists: bool = True) -> DataFrame:
    """The app log; without ``lists`` its screens as mergeable state in place of ``screen_list``."""
    v = visits_from_events(events, lists)
    shown = [F.when((F.col("user_id") % 17 == 0) & (F.col("total_screens_viewed") == 0), F.lit(None).cast("string"))
             .otherwise(F.coalesce("screen_list", F.lit(""))).alias("screen_list")] if lists else [F.col(c) for c in screens.STATE]
    # nation (25 rows) and region (5 rows) are scans whose size the planner
    # knows from file statistics; it broadcasts them under
    # spark.sql.autoBroadcastJoinThreshold without a hint or an extra job.
    geo = nation.select("n_nationkey", "n_regionkey").join(
        region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_mktsegment", "r_name")
    j = v.join(cust, v["user_id"] == cust["c_custkey"], "inner")
    uid = F.col("user_id")
    return j.select(
        uid,
        F.col("first_visit_ts").cast("string").alias("first_visit_date"),
        F.col("purchase_ts").cast("string").alias("purchase_date"),
        *shown,
        "session_count", "total_screens_viewed", "used_search_feature", "wrote_review", "added_to_wishlist",
        (F.lit(18) + (uid % 60).cast("int")).alias("age"),
        F.when(uid % 20 == 19, F.lit(None).cast("string")).when(uid % 2 == 0, "iOS").otherwise("Android").alias("platform"),
        F.col("r_name").alias("region"),
        F.when(uid % 5 == 0, "Email").when(uid % 5 == 1, "Organic Search").when(uid % 5 == 2, "Paid Search")
         .when(uid % 5 == 3, "Referral").otherwise("Social Media").alias("acquisition_channel"),
        F.concat(
            F.when(uid % 3 == 0, "Young").when(uid % 3 == 1, "Adult").otherwise("Senior"), F.lit(" "),
            F.when(F.col("c_mktsegment") == "BUILDING", "Buyer").when(F.col("c_mktsegment") == "MACHINERY", "Browser")
             .otherwise("Power User"),
        ).alias("user_segment"),
        F.concat_ws(".", (F.lit(2) + uid % 3).cast("string"), (uid % 12).cast("string"), (uid % 4).cast("string")).alias("app_version"),
        F.when(F.col("purchase_ts").isNull(), 0).otherwise(1).cast("int").alias("made_purchase"),
        F.col("first_visit_ts").alias("log_ts"),
    )


def app_log(spark: SparkSession, sf_dir: str, lists: bool = True) -> DataFrame:
    return app_log_from(*(read_table(spark, sf_dir, t) for t in ("events", "customer", "nation", "region")), lists=lists)
