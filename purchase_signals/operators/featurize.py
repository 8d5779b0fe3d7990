"""Featurization: raw app log -> label + ~50 features, one narrow projection.

``mode="train"`` keeps the training semantics (nulls stay null, label
computed); ``mode="serve"`` applies the serving defaults (missing time -> noon
on Monday, unknown platform -> 0, bad version -> 3 / 3.0, numeric nulls -> 0).
Both modes take the vocabulary behind the one-hot columns from outside (the
stored one of a feature version, see ``sources.vocabulary``), so the feature
columns never depend on the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import categorical as cat
from ..functions import dates, scores, screens


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def feature_columns(vocab: dict[str, list[str]]) -> list[str]:
    """Derived feature names, in output order."""
    names = ["hour", "dayofweek", "is_weekend"]
    names += [screens.flag_name(s) for s in C.TRACKED_SCREENS]
    names += list(C.SCREEN_CATEGORIES)
    names += ["other_screens", "engagement_score", "screen_diversity", "purchase_intent"]
    names += one_hot_columns(vocab)
    names += ["app_major_version", "version_score"]
    return names


def one_hot_columns(vocab: dict[str, list[str]]) -> list[str]:
    return list(dict.fromkeys(cat.one_hot_name(C.ONE_HOT_PREFIX[src], v)
                              for src in C.ONE_HOT_PREFIX for v in vocab.get(src, [])))


def featurize(df: DataFrame, vocab: dict[str, list[str]], mode: str = "train",
              keep_hash: bool = False, processing_version: str | None = None) -> DataFrame:
    """Features of raw rows; ``vocab`` has the categories of each one-hot source.
    Rows carry their screens as a list or, without one, as merged state."""
    if mode not in ("train", "serve"):
        raise ValueError(mode)
    serve = mode == "serve"

    # Stage 1: parse, flag and split (narrow expressions on the raw row).
    fv = dates.parse_date("first_visit_date") if _has(df, "first_visit_date") else F.lit(None).cast("timestamp_ntz")
    first: dict[str, Column] = {"_fv": fv}
    if not serve and _has(df, "purchase_date"):
        first["purchase_24h"] = dates.purchase_label(fv, dates.parse_date("purchase_date"))
    if not _has(df, "screen_list") and all(_has(df, c) for c in screens.STATE):
        first.update(screens.flags_of_state())
        first["other_screens"] = screens.others_of_state(serve=serve)
    else:
        sl = F.col("screen_list") if _has(df, "screen_list") else F.lit(None).cast("string")
        first.update(screens.screen_flags(sl))
        first["other_screens"] = screens.other_screens(sl, serve=serve)
    if serve:
        for c in ("session_count", "used_search_feature", "wrote_review", "added_to_wishlist", "total_screens_viewed"):
            if _has(df, c):
                first[c] = F.coalesce(F.col(c), F.lit(0))
    if _has(df, "platform"):
        first["platform"] = cat.platform_code("platform", serve=serve)
    seg = F.col("user_segment") if _has(df, "user_segment") else F.lit(None).cast("string")
    first["_age_group"] = cat.age_group(seg, serve=serve)
    first["_user_type"] = cat.user_type(seg, serve=serve)
    ver = F.col("app_version") if _has(df, "app_version") else F.lit(None).cast("string")
    first["app_major_version"] = cat.app_major_version(ver, serve=serve)
    first["version_score"] = cat.version_score(ver, serve=serve)
    for src in ("region", "acquisition_channel"):
        first[f"_{src}"] = F.col(src) if _has(df, src) else F.lit(None).cast("string")

    drop = {*C.RAW_DROP_COLUMNS, *screens.STATE}
    if not keep_hash:
        drop.add("record_hash")
    # Raw columns keep their position (redefined ones are replaced in place).
    kept = [c for c in df.columns if c not in drop]
    extra = [n for n in first if n not in kept]
    s1 = df.select(*[first[c].alias(c) if c in first else F.col(c) for c in kept],
                   *[first[n].alias(n) for n in extra])

    # Stage 2: counts, scores, one-hot over the stage-1 columns; Catalyst
    # collapses both selects into one projection (common subexpressions are
    # evaluated once in generated code).
    dow = dates.day_of_week("_fv", serve=serve)
    derived: dict[str, Column] = {
        "hour": dates.hour_of_day("_fv", serve=serve),
        "dayofweek": dow,
        "is_weekend": dates.is_weekend(dow),
    }
    derived.update({f: F.col(f) for f in (screens.flag_name(x) for x in C.TRACKED_SCREENS)})
    derived.update(screens.category_counts())
    derived["other_screens"] = F.col("other_screens")
    # scores read the category counts, so they are written out in full here
    counts = screens.category_counts()
    with_counts = {n: counts.get(n, F.col(n)) for n in
                   ("session_count", "used_search_feature", "wrote_review", "added_to_wishlist",
                    "total_screens_viewed", *C.SCREEN_CATEGORIES)}
    derived["engagement_score"] = scores.engagement_score(serve=serve, cols=with_counts)
    derived["screen_diversity"] = scores.screen_diversity(cols=with_counts)
    derived["purchase_intent"] = scores.purchase_intent(serve=serve, cols=with_counts)
    cat_src = {"region": F.col("_region"), "acquisition_channel": F.col("_acquisition_channel"),
               "age_group": F.col("_age_group"), "user_type": F.col("_user_type")}
    for src, prefix in C.ONE_HOT_PREFIX.items():
        derived.update(cat.one_hot(cat_src[src], prefix, vocab.get(src, [])))
    derived["app_major_version"] = F.col("app_major_version")
    derived["version_score"] = F.col("version_score")

    label = [F.col("purchase_24h")] if "purchase_24h" in first else []
    out = s1.select(*[F.col(c) for c in kept if c not in derived], *label,
                    *[e.alias(n) for n, e in derived.items()])
    out = out.toDF(*[c.lower() for c in out.columns])
    if serve:
        numeric = [f.name for f in out.schema.fields
                   if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")]
        out = out.select(*[F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)).alias(c) if c in numeric
                           else F.col(c) for c in out.columns])
    if processing_version is not None:
        out = out.withColumn("processing_version", F.lit(processing_version))
    return out
