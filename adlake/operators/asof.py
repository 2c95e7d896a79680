"""As-of joins: click attribution (J-05), impression labels (J-03) and the
point-in-time training join (J-07).

Spark has no native as-of join.  J-05 is a union + running
``last(ignorenulls)`` window.  To keep one hot (user, campaign) pair from
landing in a single task, the window runs per (key, time bucket); each
bucket's last impression is carried into later buckets through a
per-key summary that has at most one row per bucket."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.scalar import lit_date

DAY_SECONDS = 86400
HOUR_SECONDS = 3600


def attribute_clicks(
    ad_events: DataFrame,
    keys: tuple[str, ...] = ("user_id", "campaign_id"),
    max_age_seconds: int | None = None,
    bucket_seconds: int = HOUR_SECONDS,
) -> DataFrame:
    """J-05: for every click, the latest impression of the same keys at or
    before the click (ties: impression first), optionally within
    ``max_age_seconds``.  Output: click_id, keys..., impression_id,
    age_seconds (null when unattributed)."""
    ev = ad_events.select(
        *keys,
        "event_id",
        "ts",
        (F.col("event_type") == "click").alias("is_click"),
        F.unix_micros("ts").alias("us"),
    ).withColumn("bucket", F.floor(F.col("us") / F.lit(bucket_seconds * 1_000_000)).cast("long"))
    imp_id = F.when(~F.col("is_click"), F.col("event_id"))
    imp_us = F.when(~F.col("is_click"), F.col("us"))
    order = [F.col("us"), F.col("is_click").cast("int"), F.col("event_id")]
    w = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ev.select(
        *keys,
        "event_id",
        "is_click",
        "us",
        "bucket",
        F.last(imp_id, ignorenulls=True).over(w).alias("l_imp"),
        F.last(imp_us, ignorenulls=True).over(w).alias("l_us"),
    )
    # Last impression of every (keys, bucket): at most one row per bucket.
    summary = (
        ev.filter(~F.col("is_click"))
        .groupBy(*keys, "bucket")
        .agg(F.max_by(F.struct("event_id", "us"), F.struct("us", "event_id")).alias("last"))
    )
    # Carry from earlier buckets: union the per-bucket summaries with one
    # marker row per click bucket, ordered so a bucket's marker precedes its
    # own summary; a running last(ignorenulls) then yields the latest
    # impression strictly before the bucket.  At most 2 rows per bucket.
    clicks = local.filter("is_click")
    markers = clicks.select(*keys, "bucket").distinct().select(
        *keys, "bucket", F.lit(0).alias("kind"), F.lit(None).cast(summary.schema["last"].dataType).alias("last")
    )
    both = summary.select(*keys, "bucket", F.lit(1).alias("kind"), "last").unionByName(markers)
    wk = Window.partitionBy(*keys).orderBy("bucket", "kind").rowsBetween(Window.unboundedPreceding, 0)
    prior = (
        both.select(*keys, "bucket", "kind", F.last("last", ignorenulls=True).over(wk).alias("prior"))
        .filter(F.col("kind") == 0)
        .drop("kind")
    )
    out = clicks.join(prior, [*keys, "bucket"], "left").select(
        *keys,
        F.col("event_id").alias("click_id"),
        "us",
        F.coalesce(F.col("l_imp"), F.col("prior.event_id")).alias("impression_id"),
        F.coalesce(F.col("l_us"), F.col("prior.us")).alias("imp_us"),
    )
    age = (F.col("us") - F.col("imp_us")) / F.lit(1_000_000.0)
    out = out.select(*keys, "click_id", "impression_id", age.alias("age_seconds"))
    if max_age_seconds is not None:
        ok = F.col("age_seconds") <= F.lit(float(max_age_seconds))
        out = out.select(
            *keys,
            "click_id",
            F.when(ok, F.col("impression_id")).alias("impression_id"),
            F.when(ok, F.col("age_seconds")).alias("age_seconds"),
        )
    return out


def label_impressions(ad_events: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """J-03: every impression (optionally in [start, end]) with label = some
    click is attributed to it (any date).  Left join to the DISTINCT set of
    attributed impression ids: the join side is deduplicated before the
    shuffle so a popular impression cannot fan out."""
    attributed = (
        attribute_clicks(ad_events)
        .filter(F.col("impression_id").isNotNull())
        .select(F.col("impression_id").alias("event_id"))
        .distinct()
        .withColumn("label", F.lit(1))
    )
    imps = ad_events.filter(F.col("event_type") == "impression")
    if start is not None:
        imps = imps.filter(F.col("event_date") >= lit_date(start))
    if end is not None:
        imps = imps.filter(F.col("event_date") <= lit_date(end))
    return imps.join(attributed, "event_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))


def latest_within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value_cols: list[str],
    ttl_seconds: int,
    left_id: str = "request_id",
    keep_left: bool = False,
) -> DataFrame:
    """As-of lookup with a time-to-live: for every left row (key, ts), the
    latest right row of the same key with ts in (t - ttl, t] (ties: the
    right row counts as earlier, and of right rows the one with the largest
    values is the latest).  Returns left_id (or, with ``keep_left``,
    every left column - no join back needed), value_cols and
    ``age_seconds`` (nulls when nothing is live).

    Rows are bucketed by time (bucket = ttl); right rows are also copied
    into the next bucket, so each (key, bucket) window holds at most two
    buckets of one key and a hot key is split across many tasks."""
    bucket_us = ttl_seconds * 1_000_000  # a bucket spans one lifetime: two buckets hold every live row
    lstruct = F.struct(*[F.col(c) for c in left.columns]) if keep_left else F.lit(None)
    lu = left.select(
        F.col(left_id).alias("__id"), key, F.unix_micros("ts").alias("us"),
        *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in value_cols],
        F.lit(1).alias("__side"), lstruct.alias("__l"),
    )
    lnull = F.lit(None).cast(lu.schema["__l"].dataType) if keep_left else F.lit(None)
    ru = right.select(
        F.lit(None).cast(left.schema[left_id].dataType).alias("__id"), key, F.unix_micros("ts").alias("us"),
        *value_cols, F.lit(0).alias("__side"), lnull.alias("__l"),
    )
    b = F.floor(F.col("us") / F.lit(bucket_us)).cast("long")
    u = (
        lu.withColumn("bucket", b)
        .unionByName(ru.withColumn("bucket", b))
        .unionByName(ru.withColumn("bucket", b + 1))
    )
    w = Window.partitionBy(key, "bucket").orderBy("us", "__side", *value_cols).rowsBetween(Window.unboundedPreceding, 0)
    r_us = F.when(F.col("__side") == 0, F.col("us"))
    picked = u.select(
        "__id", "us", "__side", "__l",
        F.last(r_us, ignorenulls=True).over(w).alias("r_us"),
        *[F.last(F.when(F.col("__side") == 0, F.struct(*value_cols)), ignorenulls=True).over(w).alias("__v")],
    ).filter(F.col("__side") == 1)
    age = (F.col("us") - F.col("r_us")) / F.lit(1_000_000.0)
    live = age < F.lit(float(ttl_seconds))
    head = [F.col("__l." + c).alias(c) for c in left.columns] if keep_left else [F.col("__id").alias(left_id)]
    return picked.select(
        *head,
        *[F.when(live, F.col("__v")[c]).alias(c) for c in value_cols],
        F.when(live, age).alias("age_seconds"),
    )
