"""Named queries: session features in batch (twins of the streams)."""

from __future__ import annotations

import dataclasses
import datetime as dt
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import config
from adlake.operators import session_features as sf_ops
from adlake.plans.catalog import ORACLE, query
from adlake.plans.q_decisions import DV
from adlake.plans.sql_views import with_views as V
from adlake.sources import tables as tb

SESSION_AS_OF_TS = dt.datetime(2024, 1, 30, 12, 0, 0)
KNOWN_SQL = ", ".join(f"'{t}'" for t in config.KNOWN_EVENT_TYPES)


@query(
    "screens_viewed_10min_batch",
    V(
        """SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL 599999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS user_screens_viewed_10min
           FROM session_events WHERE event_type = 'app_screen_view'""",
        "session_events",
    ),
)
def screens_viewed_10min_batch(spark, sf):
    ev = tb.session_events(spark, sf)
    return sf_ops.trailing_count(ev, "app_screen_view", out="user_screens_viewed_10min").select(
        "event_id", "user_id", "user_screens_viewed_10min"
    )


@query(
    "latest_session_values",
    V(
        """SELECT user_id,
             max_by(category, ts) FILTER (WHERE event_type = 'destination_entered') AS user_current_destination_category,
             max_by(ride_type, ts) FILTER (WHERE event_type = 'ride_type_selected') AS user_current_ride_type
           FROM session_events WHERE event_type IN ('destination_entered', 'ride_type_selected') GROUP BY user_id""",
        "session_events",
    ),
)
def latest_session_values(spark, sf):
    return sf_ops.latest_values(tb.session_events(spark, sf)).select(
        "user_id", "user_current_destination_category", "user_current_ride_type"
    )


@query(
    "session_active_asof",
    V(
        f"""SELECT user_id, true AS user_session_active,
             (epoch_us(TIMESTAMP '{SESSION_AS_OF_TS}') - epoch_us(max(ts))) / 1000000.0 AS age_seconds
           FROM session_events WHERE event_type IN ({KNOWN_SQL}) AND ts <= TIMESTAMP '{SESSION_AS_OF_TS}'
           GROUP BY user_id
           HAVING (epoch_us(TIMESTAMP '{SESSION_AS_OF_TS}') - epoch_us(max(ts))) / 1000000.0 < {config.SESSION_TTL_SECONDS}""",
        "session_events",
    ),
)
def session_active_asof(spark, sf):
    return sf_ops.session_active_asof(tb.session_events(spark, sf), SESSION_AS_OF_TS)


@query(
    "event_type_counts",
    V(
        f"""SELECT event_type, count(*) AS events, event_type NOT IN ({KNOWN_SQL}) AS unknown
           FROM session_events GROUP BY event_type""",
        "session_events",
    ),
)
def event_type_counts(spark, sf):
    return sf_ops.event_type_counts(tb.session_events(spark, sf))


@query(
    "event_validation_split",
    V(
        f"""SELECT event_id, event_type, event_type IN ({KNOWN_SQL}) AS valid,
             CASE WHEN event_type NOT IN ({KNOWN_SQL}) THEN 'unknown_event_type' END AS reason
           FROM session_events""",
        "session_events",
    ),
)
def event_validation_split(spark, sf):
    return sf_ops.validation_split(tb.session_events(spark, sf))


EVENT_JSON_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)


def encode_events(ev):
    """F-15 encode: one JSON text per session event (ids as text, ISO ts)."""
    return ev.select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("event_id"),
                "event_type",
                F.col("user_id").cast("string").alias("user_id"),
                "session_id",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                "payload",
            )
        ).alias("value")
    )


def decode_events(raw, value_col: str = "value"):
    """F-15 decode: from_json (PERMISSIVE: a bad record becomes nulls and is
    routed to the bad-record side by the caller), payload default {}."""
    p = F.from_json(F.col(value_col), EVENT_JSON_SCHEMA)
    return raw.select(p.alias("e"), F.col(value_col).alias("raw")).select(
        F.col("e.event_id").alias("event_id"),
        F.col("e.event_type").alias("event_type"),
        F.col("e.user_id").alias("user_id"),
        F.col("e.session_id").alias("session_id"),
        F.to_timestamp(F.col("e.ts")).alias("ts"),
        F.coalesce(F.col("e.payload"), F.create_map().cast("map<string,string>")).alias("payload"),
        "raw",
    )


@query(
    "parse_event_json",
    V(
        """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, session_id,
             category AS payload_category, ride_type AS payload_ride_type, CAST(hour(ts) AS BIGINT) AS hour_of_day
           FROM session_events""",
        "session_events",
    ),
)
def parse_event_json(spark, sf):
    """F-15 round trip: encode every event to JSON text, decode it back."""
    dec = decode_events(encode_events(tb.session_events(spark, sf)))
    return dec.select(
        "event_id",
        "event_type",
        "user_id",
        "session_id",
        F.col("payload")["category"].alias("payload_category"),
        F.col("payload")["ride_type"].alias("payload_ride_type"),
        F.hour("ts").cast("long").alias("hour_of_day"),
    )


# ======================================================================
# Streaming keys.  Every key replays the session events of the given tables
# as JSON text in time-ordered chunks and drains a streaming query over them
# with availableNow.
# ======================================================================

import uuid  # noqa: E402

from adlake.operators import decisions as dc  # noqa: E402
from adlake.session import materialize, scratch_path  # noqa: E402
from adlake.streaming import session_stream as st  # noqa: E402

STREAM_DAYS_PER_CHUNK = 5


def _files_per_chunk(spark) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def replay(spark, sf, duplicate: bool = False, close: bool = False, days: int = STREAM_DAYS_PER_CHUNK) -> tuple[str, int]:
    """Write the replay source; returns (root, files per trigger).  ``close``
    ends it with events two days after the last one, which move the
    watermark past every window of the others."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    fpc = _files_per_chunk(spark)
    # Built once, in order of time: a chunk reads its own files only.
    ev = materialize(tb.session_events(spark, sf).repartitionByRange("ts"))
    first, last = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    chunks = st.day_chunks(first, last, days) if first else []
    st.write_replay(ev, root + "/in", chunks, fpc)
    if close:
        last = ev.agg(F.max("ts")).first()[0] + dt.timedelta(days=2)
        # One of every known type, as each stream sees its own types only.
        types = F.posexplode(F.array(*map(F.lit, config.KNOWN_EVENT_TYPES))).alias("at", "event_type")
        end = spark.range(1).select(types).select(
            (-F.col("at") - 1).cast("long").alias("event_id"), "event_type",
            F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("session_id"),
            F.lit(last).cast("timestamp").alias("ts"), F.create_map().cast("map<string,string>").alias("payload"),
        )
        st.write_replay(end, root + "/in", [(last, last + dt.timedelta(days=1))], 1, suffix="_end")
    if duplicate:
        st.write_replay(ev, root + "/in", chunks, fpc, suffix="_redelivered")
    return root, fpc


def _events_stream(spark, root, fpc):
    return st.parse(st.read_stream(spark, root + "/in", fpc)).filter(~F.col("_corrupt"))


@query("stream_parse_events", V("SELECT event_id, event_type, user_id, session_id FROM session_events", "session_events"))
def stream_parse_events(spark, sf):
    """S-06 + F-15: decode the JSON stream; good rows to the event table,
    undecodable rows to a bad-record table (idempotent per batch id)."""
    root, fpc = replay(spark, sf)
    raw = st.parse(st.read_stream(spark, root + "/in", fpc))

    def split(batch, batch_id):
        good = batch.filter(~F.col("_corrupt")).drop("raw", "_corrupt")
        bad = batch.filter(F.col("_corrupt")).select("raw")
        st.batch_partition_writer(root + "/events")(good, batch_id)
        st.batch_partition_writer(root + "/bad_records")(bad, batch_id)

    st.run_foreach_batch(raw, split, root + "/ckpt", mode="append")
    return spark.read.parquet(root + "/events").select("event_id", "event_type", "user_id", "session_id")


@query("stream_route_events", ORACLE["event_type_counts"])
def stream_route_events(spark, sf):
    """T-01: running counts per type, unknown types counted and skipped;
    the final (latest batch) count per type equals the batch twin."""
    root, fpc = replay(spark, sf)
    st.run_foreach_batch(st.route_counts(_events_stream(spark, root, fpc)), st.batch_partition_writer(root + "/out"), root + "/ckpt")
    out = spark.read.parquet(root + "/out")
    return out.groupBy("event_type").agg(F.max_by(F.struct("events", "unknown"), "batch_id").alias("s")).select(
        "event_type", "s.events", "s.unknown"
    )


@query(
    "stream_latest_values",
    f"SELECT user_id, user_current_destination_category, user_current_ride_type FROM ({ORACLE['latest_session_values']})",
)
def stream_latest_values(spark, sf):
    """T-02: latest destination / ride type per user, update mode."""
    root, fpc = replay(spark, sf)
    st.run_foreach_batch(st.latest_values(_events_stream(spark, root, fpc)), st.batch_partition_writer(root + "/out"), root + "/ckpt")
    out = spark.read.parquet(root + "/out")
    return out.groupBy("user_id").agg(
        F.max_by(F.struct("user_current_destination_category", "user_current_ride_type"), "batch_id").alias("s")
    ).select("user_id", "s.user_current_destination_category", "s.user_current_ride_type")


@query(
    "stream_screens_10min",
    f"SELECT event_id, user_id, user_screens_viewed_10min FROM ({ORACLE['screens_viewed_10min_batch']})",
)
def stream_screens_10min(spark, sf):
    """T-03: trailing 10-minute screen-view count per event, append mode to a
    Parquet sink."""
    root, fpc = replay(spark, sf, close=True)
    st.run_to_parquet(st.trailing_counts(_events_stream(spark, root, fpc), "app_screen_view"), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select("event_id", "user_id", F.col("count_10min").alias("user_screens_viewed_10min"))


@query(
    "stream_sessions",
    V(
        f"""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM (
              SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
                SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE
                               THEN 0 ELSE 1 END AS opens
                FROM session_events WHERE event_type IN ({KNOWN_SQL})))
            GROUP BY user_id, session""",
        "session_events",
    ),
)
def stream_sessions(spark, sf):
    """T-04 stream: session windows (30-minute gap) of known events."""
    root, fpc = replay(spark, sf, close=True)
    st.run_to_parquet(st.sessions(_events_stream(spark, root, fpc)), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "events",
    )


@query(
    "stream_session_flag",
    V(
        "SELECT user_id, true AS active, a AS at FROM spans UNION ALL SELECT user_id, false, b FROM spans",
        "session_events",
        extra=[
            (
                "spans",
                f"""SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 30 MINUTE AS b FROM (
                      SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS span FROM (
                        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE
                                       THEN 0 ELSE 1 END AS opens
                        FROM session_events WHERE event_type IN ({KNOWN_SQL})))
                    GROUP BY user_id, span""",
            )
        ],
    ),
)
def stream_session_flag(spark, sf):
    """T-04: changes of the session flag from keyed state with timers."""
    root, fpc = replay(spark, sf, close=True)
    st.run_to_parquet(st.session_flag(_events_stream(spark, root, fpc)), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select("user_id", "active", F.col("at").cast("timestamp_ntz").alias("at"))


@query(
    "stream_user_sliding_counts",
    V(
        f"""SELECT user_id, window_start, count(*) AS events FROM (
              SELECT user_id, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 9 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
              FROM session_events WHERE event_type IN ({KNOWN_SQL})) GROUP BY user_id, window_start""",
        "session_events",
    ),
)
def stream_user_sliding_counts(spark, sf):
    """T-05: sliding windows (10 minutes, every minute) per user."""
    root, fpc = replay(spark, sf, close=True)
    st.run_to_parquet(st.sliding_user_counts(_events_stream(spark, root, fpc)), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "events")


@query(
    "stream_hourly_type_counts",
    V(
        "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM session_events GROUP BY 1, 2",
        "session_events",
    ),
)
def stream_hourly_type_counts(spark, sf):
    """T-05: tumbling hourly counts per type with a watermark."""
    root, fpc = replay(spark, sf, close=True)
    st.run_to_parquet(st.hourly_type_counts(_events_stream(spark, root, fpc)), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events"
    )


@query("stream_dedup", V("SELECT event_id, event_type, user_id FROM session_events", "session_events"))
def stream_dedup(spark, sf):
    """T-06: every event delivered twice; each event_id kept once."""
    root, fpc = replay(spark, sf, duplicate=True)
    events = _events_stream(spark, root, fpc).drop("raw", "_corrupt", "payload")
    st.run_to_parquet(st.dedup(events), root + "/out", root + "/ckpt")
    return spark.read.parquet(root + "/out").select("event_id", "event_type", "user_id")


@query("stream_lag_report")
def stream_lag_report(spark, sf):
    """T-08: per micro-batch event count, newest event time, processing lag,
    time and throughput of the write: each batch writes its events and one row of metrics (an aggregate of
    what it wrote), so every batch is in the report however many there are."""
    root, fpc = replay(spark, sf)
    events = _events_stream(spark, root, fpc).drop("raw", "_corrupt", "payload")

    def ingest(batch, batch_id):
        begin = time.time()
        at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        st.batch_partition_writer(root + "/events")(batch, batch_id)
        seconds = time.time() - begin
        # What was written, not the batch again.
        own = spark.read.schema(batch.schema.add("batch_id", "long")).parquet(root + "/events").filter(F.col("batch_id") == batch_id)
        m = own.agg(F.count(F.lit(1)).alias("events"), F.max("ts").cast("timestamp_ntz").alias("max_event_ts"))
        lag = (F.unix_micros(F.lit(at).cast("timestamp")) - F.unix_micros(F.col("max_event_ts").cast("timestamp"))) / 1e6
        m = m.withColumns({"lag_seconds": lag, "write_seconds": F.lit(seconds), "events_per_second": F.col("events") / F.lit(seconds)})
        st.batch_partition_writer(root + "/lag")(m.filter("events > 0"), batch_id)

    st.run_foreach_batch(events, ingest, root + "/ckpt", mode="append")
    return spark.read.parquet(root + "/lag").select(
        F.col("batch_id").cast("long").alias("batch_id"), "events", "max_event_ts", "lag_seconds", "write_seconds", "events_per_second"
    )


def decide_stream(spark, sf, days: int = STREAM_DAYS_PER_CHUNK):
    """T-10: a stream of ad requests decided per micro-batch of ``days`` days
    and logged (idempotent per batch id).  A batch is joined with the static
    tables: the context of its own (user, day) pairs is built from the events,
    the catalog is read for the days that it holds.  Counters are keyed by
    (campaign, day): what earlier batches of a day have granted is taken off the
    day's quota."""
    from adlake.operators import features as ft
    from adlake.plans.q_decisions import fixture_inputs
    from adlake.sources import decision_log as dlog

    root, fpc = replay(spark, sf, days=days)
    reqs = _events_stream(spark, root, fpc).filter(F.col("event_type") == "app_screen_view").select(
        F.col("event_id").alias("request_id"), "user_id", "ts",
        F.to_date("ts").alias("request_date"), F.hour("ts").cast("long").alias("hour_of_day"),
    )
    static = fixture_inputs(spark, sf)
    # Read by every batch, computed once.
    static.destinations = materialize(static.destinations)
    static.popularity = materialize(static.popularity)
    static.ledger = materialize(static.ledger)
    # Bid responses, dependency health and latencies are side inputs keyed by request.
    side = tb.requests_enriched(spark, sf).drop("user_id", "ts", "request_date", "hour_of_day")

    def decide_batch(batch, batch_id):
        batch = materialize(batch.join(side, "request_id", "left"))
        first, last = batch.agg(F.min("request_date"), F.max("request_date")).first()
        if first is None:
            return
        day = dt.timedelta(days=1)
        context = ft.membership_context(
            tb.user_segments(spark, sf), tb.ad_events(spark, sf), tb.rides(spark, sf), first - day, last - day,
            static.audiences, spine=batch.select("user_id", F.date_sub("request_date", 1).alias("asof")).distinct(),
        )
        # A day's quota is shared by all batches that hold requests of the day.
        granted = dc.granted_wins(dlog.read(spark, root + "/log", before_batch=batch_id))
        inp = dataclasses.replace(static, requests=batch, user_context=context, granted=granted)
        d = dc.decide(inp, first, last)["decisions"]
        st.batch_partition_writer(root + "/log")(dlog.conform(d), batch_id)

    st.run_foreach_batch(reqs, decide_batch, root + "/ckpt", mode="append")
    return spark.read.parquet(root + "/log")


@query("stream_decisions", DV("SELECT request_id, winner, rung FROM dec"))
def stream_decisions(spark, sf):
    """T-10."""
    return decide_stream(spark, sf).select("request_id", "winner", "rung")
