"""DuckDB twins of the Spark plans, used as correctness oracles.

Every oracle is a plain SQL text over the pre-registered base tables. The app
log and the feature table are common table expressions built from the same
fixed values as the Spark code (``config``), written independently in SQL.
"""

from __future__ import annotations

from .. import config as C
from ..functions.categorical import one_hot_name
from ..functions.screens import flag_name

APP_LOG_SQL = """
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(date_trunc('day', ts) AS DATE) AS d,
    CASE event_type
      WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'ProductList' WHEN 1 THEN 'ProductDetail' WHEN 2 THEN 'Search' ELSE 'SearchResults' END
      WHEN 'click' THEN CASE event_id % 5 WHEN 0 THEN 'ShoppingCart' WHEN 1 THEN 'Checkout' WHEN 2 THEN 'WishList' WHEN 3 THEN 'Reviews' ELSE 'Promotions' END
      WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'Account' WHEN 1 THEN 'AddressBook' ELSE 'CategoryBrowse' END
      WHEN 'error' THEN 'Home'
    END AS screen
  FROM events),
g AS (
  SELECT user_id, d, min(ts) AS first_visit_ts, string_agg(screen, ',' ORDER BY ts, event_id) AS screen_list,
    count(*) AS session_count,
    sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END) AS total_screens_viewed,
    max(CASE WHEN screen = 'Search' THEN 1 ELSE 0 END) AS used_search_feature,
    max(CASE WHEN screen = 'Reviews' THEN 1 ELSE 0 END) AS wrote_review,
    max(CASE WHEN screen = 'WishList' THEN 1 ELSE 0 END) AS added_to_wishlist,
    min(CASE WHEN event_type = 'purchase' THEN ts END) AS day_purchase_ts
  FROM ev GROUP BY user_id, d),
p AS (
  SELECT *, min(day_purchase_ts) OVER (PARTITION BY user_id ORDER BY d
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS purchase_ts
  FROM g)
SELECT p.user_id,
  CAST(first_visit_ts AS VARCHAR(32)) AS first_visit_date,
  CAST(purchase_ts AS VARCHAR(32)) AS purchase_date,
  CASE WHEN p.user_id % 17 = 0 AND total_screens_viewed = 0 THEN NULL ELSE coalesce(screen_list, '') END AS screen_list,
  session_count, CAST(total_screens_viewed AS BIGINT) AS total_screens_viewed,
  used_search_feature, wrote_review, added_to_wishlist,
  18 + CAST(p.user_id % 60 AS INT) AS age,
  CASE WHEN p.user_id % 20 = 19 THEN NULL WHEN p.user_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS platform,
  r_name AS region,
  CASE p.user_id % 5 WHEN 0 THEN 'Email' WHEN 1 THEN 'Organic Search' WHEN 2 THEN 'Paid Search' WHEN 3 THEN 'Referral' ELSE 'Social Media' END AS acquisition_channel,
  concat(CASE p.user_id % 3 WHEN 0 THEN 'Young' WHEN 1 THEN 'Adult' ELSE 'Senior' END, ' ',
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Buyer' WHEN 'MACHINERY' THEN 'Browser' ELSE 'Power User' END) AS user_segment,
  concat(CAST(2 + p.user_id % 3 AS VARCHAR(8)), '.', CAST(p.user_id % 12 AS VARCHAR(8)), '.', CAST(p.user_id % 4 AS VARCHAR(8))) AS app_version,
  CASE WHEN purchase_ts IS NULL THEN 0 ELSE 1 END AS made_purchase,
  first_visit_ts AS log_ts
FROM p
JOIN customer ON p.user_id = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def q(name: str) -> str:
    """Double-quoted identifier (names may contain blanks)."""
    return '"' + name.replace('"', '""') + '"'


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def parse_date_sql(expr: str) -> str:
    t = f"regexp_replace(CAST({expr} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"
    formats = ", ".join(sql_str(f + time) for f in C.DATE_FORMATS_DUCKDB for time in C.TIME_SUFFIXES_DUCKDB)
    tries = [f"TRY_CAST({t} AS TIMESTAMP)", f"try_strptime({t}, [{formats}])"]
    return "coalesce(" + ", ".join(tries) + ")"


def _weighted_sql(terms, serve: bool = False) -> str:
    parts = []
    for name, w in terms:
        c = f"coalesce({name}, 0)" if serve else name
        parts.append(f"CAST({c} AS DOUBLE) * CAST({w!r} AS DOUBLE)")
    return "(" + " + ".join(parts) + ")"


def tracked_list_sql() -> str:
    return "[" + ", ".join(sql_str(s) for s in C.TRACKED_SCREENS) + "]"


def features_sql(source: str = "app_log", vocab: dict[str, list[str]] | None = None) -> str:
    """SELECT producing the training-mode feature table from ``source``.

    Column order: passthrough raw columns, label, derived features (same as
    ``featurize``).
    """
    vocab = vocab or C.FIXTURE_VOCABULARY
    fv = parse_date_sql("first_visit_date")
    pdt = parse_date_sql("purchase_date")
    sl = "coalesce(screen_list, '')"
    words = "list_filter(regexp_split_to_array(user_segment, '\\s+'), lambda x: x <> '')"
    flags = ",\n    ".join(f"CAST(contains({sl}, {sql_str(s)}) AS INTEGER) AS {flag_name(s)}" for s in C.TRACKED_SCREENS)
    stage1 = f"""
  SELECT user_id, session_count, total_screens_viewed, used_search_feature, wrote_review, added_to_wishlist, age,
    CAST(CASE platform WHEN 'iOS' THEN 1 WHEN 'Android' THEN 0 END AS INTEGER) AS platform,
    log_ts,
    CAST(CASE WHEN date_diff('microsecond', {fv}, {pdt}) / 3.6e9 <= {float(C.LABEL_HORIZON_HOURS)!r} THEN 1 ELSE 0 END AS INTEGER) AS purchase_24h,
    CAST(hour({fv}) AS INTEGER) AS hour,
    CAST(isodow({fv}) - 1 AS INTEGER) AS dayofweek,
    {flags},
    CAST(len(list_filter(string_split({sl}, ','), lambda x: x <> '' AND NOT list_contains({tracked_list_sql()}, x))) AS INTEGER) AS other_screens,
    region, acquisition_channel,
    {words}[1] AS age_group,
    array_to_string({words}[2:], ' ') AS user_type,
    TRY_CAST(trim(split_part(app_version, '.', 1)) AS INTEGER) AS app_major_version,
    list_reduce(list_transform(string_split(app_version, '.'), lambda x, i: TRY_CAST(trim(x) AS DOUBLE) / pow(10.0, i - 1)), lambda a, b: a + b, CAST(0 AS DOUBLE)) AS version_score
  FROM {source}"""
    counts = ",\n    ".join(
        f"CAST({' + '.join(flag_name(s) for s in screens)} AS INTEGER) AS {name}"
        for name, screens in C.SCREEN_CATEGORIES.items())
    stage2 = f"""
  SELECT *, CAST(CASE WHEN dayofweek IN ({', '.join(str(d) for d in C.WEEKEND_DAYS)}) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    {counts}
  FROM s1"""
    onehot = []
    src_expr = {"region": "region", "acquisition_channel": "acquisition_channel", "age_group": "age_group", "user_type": "user_type"}
    for src, prefix in C.ONE_HOT_PREFIX.items():
        for v in vocab.get(src, []):
            onehot.append(f"coalesce({src_expr[src]} = {sql_str(v)}, false) AS {q(one_hot_name(prefix, v))}")
    div = " + ".join(f"CAST({n} > 0 AS INTEGER)" for n in C.SCREEN_CATEGORIES)
    flag_cols = ", ".join(flag_name(s) for s in C.TRACKED_SCREENS)
    stage3 = f"""
  SELECT user_id, session_count, total_screens_viewed, used_search_feature, wrote_review, added_to_wishlist, age,
    platform, log_ts, purchase_24h, hour, dayofweek, is_weekend,
    {flag_cols},
    {', '.join(C.SCREEN_CATEGORIES)},
    other_screens,
    {_weighted_sql(C.ENGAGEMENT_WEIGHTS)} AS engagement_score,
    CAST({div} AS INTEGER) AS screen_diversity,
    {_weighted_sql(C.INTENT_WEIGHTS)} AS purchase_intent,
    {', '.join(onehot)},
    app_major_version, version_score
  FROM s2"""
    return f"WITH s1 AS ({stage1}), s2 AS ({stage2}) {stage3}"


def with_tables(body: str, recursive: bool = False, **ctes: str) -> str:
    """Prefix ``body`` with named CTEs (each a full SELECT, may contain WITH)."""
    if not ctes:
        return body
    defs = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{defs}\n{body}"


def with_app_log(body: str, features: bool = False, recursive: bool = False, **extra: str) -> str:
    ctes = {"app_log": APP_LOG_SQL}
    if features:
        ctes["feat"] = features_sql("app_log")
    ctes.update(extra)
    return with_tables(body, recursive=recursive, **ctes)
