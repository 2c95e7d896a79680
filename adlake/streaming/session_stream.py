"""Structured Streaming session features (S-06, T-01 .. T-10).

Source: JSON event text (a file directory here; a Kafka topic carries the
same ``value`` column).  Parsing is PERMISSIVE: a record that does not
decode goes to a bad-record side output instead of failing the query.

Event-time semantics (a documented difference from the reference, which
has no watermark): a 10-minute watermark, late rows dropped, latest value
by event time.  Output sinks are exactly-once Parquet file sinks or
``foreachBatch`` writers that overwrite their own ``batch_id`` partition
(idempotent on replay after a failure)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adlake import config

WATERMARK_SECONDS = 600
WATERMARK = f"{WATERMARK_SECONDS} seconds"
#: Timers and keyed state need a store that is not held in memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_SCHEMA = (
    "event_id string, event_type string, user_id string, session_id string, ts string, payload map<string,string>"
)


# ------------------------------------------------------------------ source


def encode(events: DataFrame) -> DataFrame:
    """F-15 encode: one JSON text per event (ids as text, ISO timestamp)."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("event_id"),
                "event_type",
                F.col("user_id").cast("string").alias("user_id"),
                "session_id",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                "payload",
            )
        ).alias("value"),
        F.col("ts").alias("_ts"),
    )


def write_replay(
    events: DataFrame, path: str, chunks: list[tuple[dt.datetime, dt.datetime]], files_per_chunk: int = 1, suffix: str = ""
) -> list[str]:
    """Write the events as JSON text, one sub-directory per time chunk, in
    time order (each chunk is its own write, so file modification times
    follow event time and a file stream reads the chunks in order)."""
    enc = encode(events)
    out = []
    for i, (lo, hi) in enumerate(chunks):
        p = f"{path.rstrip('/')}/chunk={i:04d}{suffix}"
        part = enc.filter((F.col("_ts") >= F.lit(lo)) & (F.col("_ts") < F.lit(hi)))
        part.repartitionByRange(files_per_chunk, "_ts").select("value").write.mode("overwrite").text(p)
        out.append(p)
    return out


def day_chunks(start: dt.date, end: dt.date, days_per_chunk: int) -> list[tuple[dt.datetime, dt.datetime]]:
    out = []
    d = start
    while d <= end:
        e = min(end, d + dt.timedelta(days=days_per_chunk - 1))
        out.append((dt.datetime.combine(d, dt.time()), dt.datetime.combine(e + dt.timedelta(days=1), dt.time())))
        d = e + dt.timedelta(days=1)
    return out


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Raw JSON text stream (one ``value`` per record)."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(f"{path.rstrip('/')}/chunk=*")
    )


def parse(raw: DataFrame) -> DataFrame:
    """S-06 / F-15 decode: typed columns + ``_corrupt`` flag (PERMISSIVE);
    payload defaults to {}; event time as TIMESTAMP (watermarks need it)."""
    p = F.from_json(F.col("value"), EVENT_SCHEMA)
    parsed = raw.select(p.alias("e"), "value")
    ok = F.col("e").isNotNull() & F.col("e.event_id").isNotNull() & F.col("e.ts").isNotNull()
    return parsed.select(
        F.col("e.event_id").cast("long").alias("event_id"),
        F.col("e.event_type").alias("event_type"),
        F.col("e.user_id").cast("long").alias("user_id"),
        F.col("e.session_id").alias("session_id"),
        F.to_timestamp(F.col("e.ts")).alias("ts"),
        F.coalesce(F.col("e.payload"), F.create_map().cast("map<string,string>")).alias("payload"),
        F.col("value").alias("raw"),
        (~ok).alias("_corrupt"),
    )


# ------------------------------------------------------------- operators


def known(col: str = "event_type"):
    return F.col(col).isin(*config.KNOWN_EVENT_TYPES)


def route_counts(events: DataFrame) -> DataFrame:
    """T-01 / A-19: running count per event type with the unknown flag
    (types without a handler are counted and skipped)."""
    return events.groupBy("event_type").agg(F.count("*").alias("events")).select(
        "event_type", "events", (~known()).alias("unknown")
    )


def latest_values(events: DataFrame) -> DataFrame:
    """T-02: per user the latest destination category and ride type by
    event time (update mode; state = one row per user)."""
    dest = F.col("event_type") == "destination_entered"
    ride = F.col("event_type") == "ride_type_selected"
    key = F.struct("ts", "event_id")
    return events.filter(dest | ride).groupBy("user_id").agg(
        F.max_by(F.when(dest, F.col("payload")["category"]), F.when(dest, key)).alias("user_current_destination_category"),
        F.max(F.when(dest, F.col("ts"))).alias("destination_ts"),
        F.max_by(F.when(ride, F.col("payload")["ride_type"]), F.when(ride, key)).alias("user_current_ride_type"),
        F.max(F.when(ride, F.col("ts"))).alias("ride_type_ts"),
    )


def trailing_counts(events: DataFrame, event_type: str, window_seconds: int = config.TRAILING_COUNT_SECONDS) -> DataFrame:
    """T-03: per event of ``event_type``, the user's distinct events of that
    type in (t - window, t].  Windows of two lengths that start every length
    hold the events of one length, and those of the length before that their
    counts take in, so a busy user's events are split by time.  A window is
    emitted when the watermark has passed it: its counts are final (late rows
    included).  Events without a user have no count."""
    ev = events.filter((F.col("event_type") == event_type) & F.col("user_id").isNotNull())
    ev = ev.select("event_id", "user_id", "ts").withWatermark("ts", WATERMARK).dropDuplicatesWithinWatermark(["event_id"])
    span = F.window("ts", f"{2 * window_seconds} seconds", f"{window_seconds} seconds").alias("w")
    held = ev.groupBy("user_id", span).agg(F.collect_list(F.struct("event_id", "ts")).alias("seen"))
    length = F.expr(f"INTERVAL {window_seconds} SECONDS")
    own = F.filter("seen", lambda e: e["ts"] >= F.col("w.start") + length)
    near = lambda t: F.filter("seen", lambda x: (x["ts"] <= t) & (x["ts"] > t - length))
    # Events of one time share their count.
    at = F.array_distinct(F.transform(own, lambda e: e["ts"]))
    counts = F.map_from_arrays(at, F.transform(at, lambda t: F.size(near(t)).cast("long")))
    held = held.select("user_id", own.alias("own"), counts.alias("counts"))
    counted = F.transform("own", lambda e: F.struct(
        e["event_id"].alias("event_id"), e["ts"].alias("ts"), F.col("counts")[e["ts"]].alias("count_10min")
    ))
    return held.select("user_id", F.explode(counted).alias("e")).select("e.event_id", "user_id", "e.ts", "e.count_10min")


FLAG_OUT = "user_id long, active boolean, at timestamp"
#: Groups of users with a common state; part of the state's key, so fixed for a checkpoint's life.
FLAG_GROUPS = 1024


class SessionFlag(StatefulProcessor):
    """State of a group of users: their spans of activity as (first, last) event
    times whose changes are not all reported yet, as columns.  An event-time
    timer stands at the earliest change that is due (the start of a span, or
    1,800 s after its last event); when the watermark passes it, no accepted
    row can change what lies before the watermark, and all changes up to there
    are emitted.  Calls, state updates and timers number a few for each group
    and micro-batch, however many users and events there are."""

    TTL_US = config.SESSION_TTL_SECONDS * 1_000_000
    #: The user (0 without an id), whether there is an id, first and last event, whether the start is reported.
    COLUMNS = ("user", "named", "first", "last", "reported")
    KINDS = (np.int64, bool, np.int64, np.int64, bool)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState("spans", "user array<long>, named array<boolean>, first array<long>, last array<long>, reported array<boolean>")

    def _spans(self) -> list[np.ndarray]:
        held = self.spans.get() if self.spans.exists() else [[]] * len(self.COLUMNS)
        return [np.array(c, kind) for c, kind in zip(held, self.KINDS, strict=True)]

    def _keep(self, spans: list[np.ndarray]) -> None:
        """Store the spans, with a timer at their earliest change."""
        first, last, reported = spans[2:]
        if not len(first):
            self.spans.clear()
            return
        self.spans.update(tuple(c.tolist() for c in spans))
        due = min([int(last.min()) + self.TTL_US, *first[~reported].tolist()])
        self.handle.registerTimer(-(-due // 1000))

    def _joined(self, spans: list[np.ndarray]) -> list[np.ndarray]:
        """Spans of a user that are less than the lifetime apart become one."""
        order = np.lexsort((spans[2], spans[0], spans[1]))
        user, named, first, last, reported = (c[order] for c in spans)
        other = np.concatenate([[True], (user[1:] != user[:-1]) | (named[1:] != named[:-1])])
        # The latest event of the user's spans so far, by the ranks of times.
        times, rank = np.unique(last, return_inverse=True)
        so_far = times[np.maximum.accumulate((np.cumsum(other) - 1) * len(times) + rank) % len(times)]
        opens = np.flatnonzero(other | np.concatenate([[True], first[1:] - so_far[:-1] >= self.TTL_US]))
        return [user[opens], named[opens], first[opens], np.maximum.reduceat(last, opens), np.logical_or.reduceat(reported, opens)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [self._spans()]
        for pdf in rows:
            at = pdf["ts"].to_numpy("datetime64[us]").astype(np.int64)
            parts.append([pdf["user"].to_numpy(np.int64), pdf["named"].to_numpy(bool), at, at, np.zeros(len(at), bool)])
        self._keep(self._joined([np.concatenate(c) for c in zip(*parts, strict=True)]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        spans = self._spans()
        user, named, first, last, reported = spans
        on, off = (first <= now) & ~reported, last + self.TTL_US <= now
        if not (on | off).any():
            return  # an earlier timer of this watermark has emitted all
        reported |= on
        self._keep([c[~off] for c in spans])
        whose = pd.arrays.IntegerArray(np.concatenate([user[on], user[off]]), ~np.concatenate([named[on], named[off]]))
        at = np.concatenate([first[on], last[off] + self.TTL_US]).astype("datetime64[us]")
        yield pd.DataFrame({"user_id": whose, "active": np.repeat([True, False], [on.sum(), off.sum()]), "at": at})

    def close(self) -> None:
        pass


def session_flag(events: DataFrame) -> DataFrame:
    """T-04 stream: every change of a user's session flag (user_id, active,
    at): on with the first KNOWN event, off 1,800 s after the last one.  Events
    without a user are those of one user."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ev = events.filter(known()).select(
        F.pmod(F.xxhash64("user_id"), F.lit(FLAG_GROUPS)).alias("users"), F.coalesce("user_id", F.lit(0)).cast("long").alias("user"),
        F.col("user_id").isNotNull().alias("named"), "ts",
    )
    return ev.withWatermark("ts", WATERMARK).groupBy("users").transformWithStateInPandas(
        statefulProcessor=SessionFlag(), outputStructType=FLAG_OUT, outputMode="append", timeMode="EventTime"
    )


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """T-04 stream: activity sessions of KNOWN events with a 30-minute gap."""
    ev = events.filter(known()).withWatermark("ts", WATERMARK)
    s = ev.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("events"))
    return s.select(
        "user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events"
    )


def hourly_type_counts(events: DataFrame) -> DataFrame:
    """T-05: tumbling one-hour counts per event type (append on watermark)."""
    ev = events.withWatermark("ts", WATERMARK)
    w = ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events"))
    return w.select(F.col("w.start").alias("window_start"), "event_type", "events")


def sliding_user_counts(events: DataFrame, window_seconds: int = 600, slide_seconds: int = 60) -> DataFrame:
    """T-05: per user the KNOWN events of every sliding window (append on
    watermark; the window is a multiple of the slide).  The state has an event
    twice, not once a window: blocks of two windows' length that start every
    length hold what the windows that start in a block's first half need, and
    are cut into those windows when the watermark has passed the block."""
    ev = events.filter(known()).withWatermark("ts", WATERMARK)
    block = F.window("ts", f"{2 * window_seconds} seconds", f"{window_seconds} seconds").alias("b")
    held = ev.groupBy("user_id", block).agg(F.collect_list(F.unix_micros("ts")).alias("at"))
    length, slide = window_seconds * 1_000_000, slide_seconds * 1_000_000
    begin = F.unix_micros("b.start")
    starts = F.sequence(begin, begin + F.lit(length - slide), F.lit(slide))
    inside = lambda s: F.size(F.filter("at", lambda t: (t >= s) & (t < s + F.lit(length)))).cast("long")
    counted = F.transform(starts, lambda s: F.struct(s.alias("start"), inside(s).alias("events")))
    w = held.select("user_id", F.explode(F.filter(counted, lambda c: c["events"] > 0)).alias("w"))
    return w.select("user_id", F.timestamp_micros("w.start").alias("window_start"), "w.events")


def dedup(events: DataFrame) -> DataFrame:
    """T-06: a redelivered event_id is kept once (state bounded by the watermark)."""
    return events.withWatermark("ts", WATERMARK).dropDuplicatesWithinWatermark(["event_id"])


# ------------------------------------------------------------------ sinks


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Exactly-once file sink, drained with availableNow."""
    q = (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "update"):
    """foreachBatch sink drained with availableNow; returns the query so the
    caller can read its progress (T-08)."""
    q = (
        df.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def batch_partition_writer(out: str):
    """foreachBatch writer that overwrites its own batch_id partition, so a
    re-run batch after a failure replaces, not duplicates, its rows."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(out)

    return fn


# ---------------------------------------------------------- plug-in specs


class StreamFeatureSpec:
    """X-02: a stream feature declares the event type it listens to and the
    aggregate kind; the framework builds the streaming DataFrame:
      latest          latest payload[payload_key] per user (update mode)
      trailing_count  distinct events in (t - window, t] per event
      presence        changes of the session flag (timers)
    """

    def __init__(self, name: str, event_type: str | None, kind: str, payload_key: str | None = None,
                 window_seconds: int | None = None):
        self.name, self.event_type, self.kind = name, event_type, kind
        self.payload_key, self.window_seconds = payload_key, window_seconds


# The registry's session features (names and windows from config.REGISTRY).
STREAM_FEATURES = [
    StreamFeatureSpec("user_session_active", None, "presence"),
    StreamFeatureSpec("user_current_destination_category", "destination_entered", "latest", "category"),
    StreamFeatureSpec("user_current_ride_type", "ride_type_selected", "latest", "ride_type"),
    StreamFeatureSpec("user_screens_viewed_10min", "app_screen_view", "trailing_count", window_seconds=config.TRAILING_COUNT_SECONDS),
    StreamFeatureSpec("promos_viewed_10min", "promo_viewed", "trailing_count", window_seconds=config.TRAILING_COUNT_SECONDS),
]


def build_stream_feature(events: DataFrame, spec: StreamFeatureSpec) -> DataFrame:
    """One streaming DataFrame per declared feature, over one parsed stream."""
    if spec.kind == "latest":
        ev = events.filter(F.col("event_type") == spec.event_type)
        return ev.groupBy("user_id").agg(
            F.max_by(F.col("payload")[spec.payload_key], F.struct("ts", "event_id")).alias(spec.name),
            F.max("ts").alias("updated_ts"),
        )
    if spec.kind == "trailing_count":
        return trailing_counts(events, spec.event_type, spec.window_seconds).withColumnRenamed("count_10min", spec.name)
    if spec.kind == "presence":
        return session_flag(events).withColumnRenamed("active", spec.name)
    raise ValueError(f"unknown stream feature kind {spec.kind!r}")
