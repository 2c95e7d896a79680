"""Session features on batch data (W-02, W-03, T-04, A-19, P-11): the batch
twins of the streaming jobs, also used for as-of lookups (E-01)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake import config

MICROS = 1_000_000
HOUR_US = 3600 * MICROS


def trailing_count(
    events: DataFrame,
    event_type: str,
    window_seconds: int = config.TRAILING_COUNT_SECONDS,
    bucket_us: int | None = None,
    out: str = "count_10min",
) -> DataFrame:
    """W-02: for each event of ``event_type``, the number of distinct events
    (by event_id) of that user and type with ts in (t - window, t].

    Skew-safe form: rows are bucketed by the window length; each bucket also sees the
    previous bucket's rows as context (window < bucket), so the window is
    partitioned by (user, bucket) instead of by user alone.  Redelivered
    event ids are dropped inside the same partition (adjacent after the
    sort), so no extra shuffle is needed for de-duplication."""
    bucket_us = bucket_us or window_seconds * MICROS  # one window per bucket
    assert window_seconds * MICROS <= bucket_us
    ev = events.filter(F.col("event_type") == event_type).select(
        "event_id", "user_id", "ts", F.unix_micros("ts").alias("us")
    )
    b = F.floor(F.col("us") / F.lit(bucket_us)).cast("long")
    own = ev.select("*", b.alias("bucket"), F.lit(True).alias("own"))
    ctx = ev.select("*", (b + 1).alias("bucket"), F.lit(False).alias("own"))
    u = own.unionByName(ctx)
    wdup = Window.partitionBy("user_id", "bucket").orderBy("us", "event_id", F.col("own").desc())
    u = u.withColumn(
        "first", F.coalesce(F.lag("event_id").over(wdup) != F.col("event_id"), F.lit(True)).cast("int")
    )
    wr = Window.partitionBy("user_id", "bucket").orderBy("us").rangeBetween(-(window_seconds * MICROS - 1), 0)
    counted = u.withColumn(out, F.sum("first").over(wr).cast("long"))
    return counted.filter(F.col("own") & (F.col("first") == 1)).select("event_id", "user_id", "ts", out)


def latest_values(events: DataFrame, as_of_ts: dt.datetime | None = None) -> DataFrame:
    """W-03: per user the latest destination category and ride type (latest
    by (ts, event_id)), with their timestamps.  max_by is partially
    aggregated map-side, so hot users do not skew."""
    ev = events
    if as_of_ts is not None:
        ev = ev.filter(F.col("ts") <= F.lit(as_of_ts))
    dest = F.col("event_type") == "destination_entered"
    ride = F.col("event_type") == "ride_type_selected"
    key = F.struct("ts", "event_id")
    return ev.filter(dest | ride).groupBy("user_id").agg(
        F.max_by(F.when(dest, F.col("payload")["category"]), F.when(dest, key)).alias(
            "user_current_destination_category"
        ),
        F.max(F.when(dest, F.col("ts"))).alias("destination_ts"),
        F.max_by(F.when(ride, F.col("payload")["ride_type"]), F.when(ride, key)).alias("user_current_ride_type"),
        F.max(F.when(ride, F.col("ts"))).alias("ride_type_ts"),
    )


def known_type(col: Column | None = None) -> Column:
    c = col if col is not None else F.col("event_type")
    return c.isin(*config.KNOWN_EVENT_TYPES)


def session_active_asof(events: DataFrame, as_of_ts: dt.datetime) -> DataFrame:
    """T-04 batch: users whose last KNOWN event at or before as_of_ts is less
    than 1,800 s old (the feature is absent otherwise)."""
    ev = events.filter(known_type() & (F.col("ts") <= F.lit(as_of_ts)))
    last = ev.groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    age = F.unix_micros(F.lit(as_of_ts).cast("timestamp")) - F.unix_micros("last_ts")
    return last.select(
        "user_id", F.lit(True).alias("user_session_active"), (age / F.lit(float(MICROS))).alias("age_seconds")
    ).filter(F.col("age_seconds") < config.SESSION_TTL_SECONDS)


def event_type_counts(events: DataFrame) -> DataFrame:
    """A-19: events consumed per type, flagged unknown when no handler exists
    (the known-type list is a literal IN, no join needed)."""
    return events.groupBy("event_type").agg(F.count("*").alias("events")).select(
        "event_type", "events", (~known_type()).alias("unknown")
    )


def validation_split(events: DataFrame) -> DataFrame:
    """P-11: every event with valid flag and the first failing reason."""
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    reason = (
        F.when(~known_type(), F.lit("unknown_event_type"))
        .when(empty("event_id") | empty("user_id") | empty("session_id"), F.lit("missing_id"))
    )
    return events.select("event_id", "event_type", reason.isNull().alias("valid"), reason.alias("reason"))


def session_active_at_requests(events: DataFrame, requests: DataFrame) -> DataFrame:
    """T-04 per request: 1 if the user had a KNOWN event in the 1,800 s
    before (and including) the request time, else absent."""
    from adlake.operators.asof import latest_within

    known = events.filter(known_type()).select("user_id", "ts", F.lit(1).alias("user_session_active"))
    hit = latest_within(requests, known, "user_id", ["user_session_active"], config.SESSION_TTL_SECONDS)
    return hit.filter(F.col("user_session_active").isNotNull()).select("request_id", "user_session_active")


def stored_values(events: DataFrame, window_seconds: int = config.TRAILING_COUNT_SECONDS) -> DataFrame:
    """E-01: what the session store holds after each KNOWN event, as one row
    (user_id, us, and a value in the column of each feature that the event
    writes): the flag, the destination, the ride type, and the trailing counts
    of screens and promos at the event (events are unique, see T-06).

    The counts are one range frame per (user, type, bucket of a window); each
    bucket sees the one before, so a busy user is split by time."""
    t, us = F.col("event_type"), F.unix_micros("ts")
    width = window_seconds * MICROS
    counted = t.isin("app_screen_view", "promo_viewed")
    e = events.filter(known_type()).select(
        "user_id", "event_type", us.alias("us"), F.col("payload")["category"].alias("category"),
        F.col("payload")["ride_type"].alias("ride_type"),
    )
    bucket = F.floor(F.col("us") / width)
    copies = F.when(counted, F.array(F.struct(bucket.alias("b"), F.lit(True).alias("own")), F.struct((bucket + 1).alias("b"), F.lit(False).alias("own")))).otherwise(
        F.array(F.struct(bucket.alias("b"), F.lit(True).alias("own")))
    )
    e = e.withColumn("at", F.explode(copies)).select("*", "at.b", "at.own").drop("at")
    w = Window.partitionBy("user_id", "event_type", "b").orderBy("us").rangeBetween(-(width - 1), 0)
    e = e.withColumn("n", F.when(counted, F.count("*").over(w))).filter("own")
    return e.select(
        "user_id", "us", F.lit(True).alias("user_session_active"),
        F.when(t == "destination_entered", F.col("category")).alias("user_current_destination_category"),
        F.when(t == "ride_type_selected", F.col("ride_type")).alias("user_current_ride_type"),
        F.when(t == "app_screen_view", F.col("n")).alias("user_screens_viewed_10min"),
        F.when(t == "promo_viewed", F.col("n")).alias("promos_viewed_10min"),
    )


SESSION_FEATURES = [
    "user_session_active", "user_current_destination_category", "user_current_ride_type", "user_screens_viewed_10min",
    "promos_viewed_10min",
]


def session_values_at(requests: DataFrame, events: DataFrame, ttl_seconds: int = config.SESSION_TTL_SECONDS) -> DataFrame:
    """E-01 for a table of requests (with user_id and ts): its columns and, for
    each session feature, a struct (value, age_seconds) of the last write that
    is younger than the lifetime, or null.  One window carries the last value
    of all features; a bucket is a lifetime and sees the one before."""
    width = ttl_seconds * MICROS
    writes = stored_values(events)
    bucket = F.floor(F.col("us") / width)
    writes = writes.withColumn("b", F.explode(F.array(bucket, bucket + 1)))
    mine = F.struct(*requests.columns)
    r = requests.select("user_id", F.unix_micros("ts").alias("us"), mine.alias("r")).withColumn("b", bucket)
    both = writes.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy("user_id", "b").orderBy("us").rangeBetween(Window.unboundedPreceding, 0)
    last = {f: F.max(F.when(F.col(f).isNotNull(), F.struct(F.col("us").alias("us"), F.col(f).alias("value")))).over(w) for f in SESSION_FEATURES}
    x = both.select("r", "us", *(c.alias(f) for f, c in last.items())).filter(F.col("r").isNotNull())
    age = lambda f: F.col("us") - F.col(f)["us"]
    live = {f: F.when(age(f) < width, F.struct(F.col(f)["value"].alias("value"), (age(f) / float(MICROS)).alias("age_seconds"))) for f in SESSION_FEATURES}
    return x.select("r.*", *(c.alias(f) for f, c in live.items()))
