"""Session features: hand cases, streaming operators vs their batch twins,
restart recovery."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from adlake import config
from adlake.operators import session_features as sfo
from adlake.session import scratch_path
from adlake.streaming import session_stream as st
from conftest import SF001

T0 = dt.datetime(2026, 7, 1, 0, 0, 0)


def events(spark, rows):
    """rows: (event_id, event_type, user_id, seconds after T0)."""
    data = [(e, t, u, f"{u}-s", T0 + dt.timedelta(seconds=s), {}) for e, t, u, s in rows]
    return spark.createDataFrame(
        data, "event_id long, event_type string, user_id long, session_id string, ts timestamp, payload map<string,string>"
    )


def test_trailing_count_window(spark):
    a = events(spark, [(1, "app_screen_view", 1, 1000), (2, "app_screen_view", 1, 1100)])
    got = {r.event_id: r.count_10min for r in sfo.trailing_count(a, "app_screen_view").collect()}
    assert got == {1: 1, 2: 2}
    b = events(spark, [(1, "app_screen_view", 1, 1000), (2, "app_screen_view", 1, 1700)])
    got = {r.event_id: r.count_10min for r in sfo.trailing_count(b, "app_screen_view").collect()}
    assert got == {1: 1, 2: 1}


def test_trailing_count_features_independent_and_dedup(spark):
    ev = events(
        spark,
        [
            (1, "app_screen_view", 1, 10),
            (2, "promo_viewed", 1, 20),
            (3, "app_screen_view", 1, 30),
            (3, "app_screen_view", 1, 30),  # redelivered
            (4, "app_screen_view", 2, 40),
        ],
    )
    s = {r.event_id: r.count_10min for r in sfo.trailing_count(ev, "app_screen_view").collect()}
    p = {r.event_id: r.count_10min for r in sfo.trailing_count(ev, "promo_viewed").collect()}
    assert s == {1: 1, 3: 2, 4: 1}
    assert p == {2: 1}


def _streamed(spark, chunks, build):
    """Runs ``build`` over chunks of event rows, one micro-batch each."""
    root = scratch_path(spark, f"chunks-{uuid.uuid4().hex}")
    for i, rows in enumerate(chunks):
        st.encode(events(spark, rows)).select("value").coalesce(1).write.text(f"{root}/in/chunk={i:04d}")
    parsed = st.parse(st.read_stream(spark, root + "/in", 1)).filter(~F.col("_corrupt"))
    df = build(parsed)
    st.run_to_parquet(df, root + "/out", root + "/ckpt")
    return spark.read.schema(df.schema).parquet(root + "/out").collect()


SCREEN, END = "app_screen_view", [(-1, "app_screen_view", -1, 10**6)]


def test_streamed_trailing_counts_take_late_and_repeated_rows(spark):
    chunks = [
        [(1, SCREEN, 7, 1000), (2, SCREEN, 7, 1100)],
        [(2, SCREEN, 7, 1100), (3, SCREEN, 7, 1700)],  # 2 is redelivered; at 1700 the one at 1100 is out
        [(4, SCREEN, 7, 1500), (5, SCREEN, 7, 1710), (6, SCREEN, 8, 1710)],  # 4 is late, inside the delay
        END,
    ]
    got = {r.event_id: r.count_10min for r in _streamed(spark, chunks, lambda e: st.trailing_counts(e, SCREEN))}
    assert got == {1: 1, 2: 2, 3: 2, 4: 3, 5: 3, 6: 1}


def test_streamed_trailing_counts_of_a_busy_user(spark):
    """One user with nearly all rows: the join deals them by time, and no
    Python runs in the plan."""
    rows = [(i, SCREEN, 1, 7 * i) for i in range(600)] + [(1000 + i, SCREEN, 2 + i, 60 * i) for i in range(30)]
    plans = []

    def build(e):
        out = st.trailing_counts(e, SCREEN)
        plans.append(out._jdf.queryExecution().analyzed().toString())
        return out

    got = {r.event_id: r.count_10min for r in _streamed(spark, [rows[:300], rows[300:], END], build)}
    want = {r.event_id: r.count_10min for r in sfo.trailing_count(events(spark, rows), SCREEN).collect()}
    assert got == want
    assert "Pandas" not in plans[0] and "Python" not in plans[0]


def test_session_flag_changes(spark):
    t = config.SESSION_TTL_SECONDS
    chunks = [
        [(1, "session_start", 1, 0), (2, SCREEN, 1, 900), (3, "error", 2, 0)],  # the unknown type starts nothing
        [(4, SCREEN, 1, 900 + t), (5, SCREEN, 3, 900 + t)],  # exactly at the end: off and on again
        [(6, SCREEN, 3, 500 + t)],  # late: the span begins earlier
        END,
    ]
    got = sorted((r.user_id, r["at"], r.active) for r in _streamed(spark, chunks, st.session_flag))
    at = lambda s: T0 + dt.timedelta(seconds=s)
    assert got == [
        (1, at(0), True), (1, at(900 + t), False), (1, at(900 + t), True), (1, at(900 + 2 * t), False),
        (3, at(500 + t), True), (3, at(900 + 2 * t), False),
    ]


def test_session_flag_calls_do_not_grow_with_users(spark):
    """A state and a call for every user took the stream hours; groups of users have one."""
    t = config.SESSION_TTL_SECONDS
    users = range(3000)
    chunks = [
        [*((u, SCREEN, u, u % 7) for u in users), (9000, SCREEN, None, 5)],
        [*((10000 + u, SCREEN, u, 100 + t * (1 + u % 2)) for u in users), (9001, SCREEN, None, t)],
        END,
    ]
    got = sorted((-1 if r.user_id is None else r.user_id, r["at"], r.active) for r in _streamed(spark, chunks, st.session_flag))
    want = []
    for u, seen in [*((u, [u % 7, 100 + t * (1 + u % 2)]) for u in users), (-1, [5, t])]:
        apart = seen[1] - seen[0] >= t
        want += [(u, T0 + dt.timedelta(seconds=x), on) for x, on in [(seen[0], True), (seen[1] + t, False), *([(seen[0] + t, False), (seen[1], True)] if apart else [])]]
    assert got == sorted(want)


def test_session_flag_state_is_of_groups():
    """One state, one update and one timer for all users of a group."""

    class Handle:
        value, timers, updates = None, [], 0

        def getValueState(self, name, schema):
            return self

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.updates = value, self.updates + 1

        def clear(self):
            self.value = None

        def registerTimer(self, at):
            self.timers.append(at)

        def getExpiryTimeInMs(self):
            return self.timers[-1]

    p, h = st.SessionFlag(), Handle()
    p.init(h)
    ttl = p.TTL_US
    at = np.array([10, 10 + ttl - 1, 5, 5 + ttl, 7])
    rows = pd.DataFrame({"user": [1, 1, 2, 2, 0], "named": [True, True, True, True, False], "ts": at.astype("datetime64[us]")})
    assert not list(p.handleInputRows((0,), iter([rows[:2], rows[2:]]), None))
    assert (h.updates, h.timers) == (1, [1])  # 5 microseconds, in milliseconds
    h.getCurrentWatermarkInMs = lambda: (ttl + 20) // 1000
    out = pd.concat(p.handleExpiredTimer((0,), h, h))
    assert sorted(zip(out["user_id"].fillna(-1), out["active"], strict=True)) == [(-1, True), (1, True), (2, True)]
    h.getCurrentWatermarkInMs = lambda: 3 * ttl // 1000
    out = pd.concat(p.handleExpiredTimer((0,), h, h))
    us = lambda x: np.array(x).astype("datetime64[us]")
    assert sorted(zip(out["user_id"].fillna(-1), out["active"], out["at"], strict=True)) == [
        (-1, False, us(7 + ttl)), (1, False, us(9 + 2 * ttl)), (2, False, us(5 + ttl)), (2, False, us(5 + 2 * ttl)), (2, True, us(5 + ttl))
    ]
    assert h.value is None and not list(p.handleExpiredTimer((0,), h, h))


def test_session_active_and_unknown_types(spark):
    ev = events(spark, [(1, "session_start", 1, 0), (2, "error", 2, 0), (3, "app_screen_view", 3, 0)])
    act = {r.user_id for r in sfo.session_active_asof(ev, T0 + dt.timedelta(seconds=1799)).collect()}
    assert act == {1, 3}  # the unknown type does not start a session
    assert sfo.session_active_asof(ev, T0 + dt.timedelta(seconds=1800)).count() == 0
    counts = {r.event_type: (r.events, r.unknown) for r in sfo.event_type_counts(ev).collect()}
    assert counts["error"] == (1, True) and counts["session_start"] == (1, False)


def _run(spark, sf, key):
    import __spark_entry__ as E

    return E.queries()[key](spark, sf)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_stream_twins_match_batch(spark):
    cols = ["event_id", "user_id", "user_screens_viewed_10min"]
    assert _rows(_run(spark, SF001, "stream_screens_10min"), cols) == _rows(_run(spark, SF001, "screens_viewed_10min_batch"), cols)
    cols = ["user_id", "user_current_destination_category", "user_current_ride_type"]
    assert _rows(_run(spark, SF001, "stream_latest_values"), cols) == _rows(_run(spark, SF001, "latest_session_values"), cols)
    cols = ["event_type", "events", "unknown"]
    assert _rows(_run(spark, SF001, "stream_route_events"), cols) == _rows(_run(spark, SF001, "event_type_counts"), cols)
    dd = _run(spark, SF001, "stream_dedup")
    assert dd.count() == dd.select("event_id").distinct().count() == spark.read.parquet(SF001 + "/events.parquet").count()


def test_stream_restart_recovers_without_loss(spark):
    """T-09: stop after the first chunk, add the rest, restart on the same
    checkpoint: the file sink holds every event exactly once."""
    from adlake.sources import tables as tb

    root = scratch_path(spark, f"restart-{uuid.uuid4().hex}")
    ev = tb.session_events(spark, SF001)
    chunks = st.day_chunks(config.FIXTURE_START, config.FIXTURE_AS_OF, 10)
    st.write_replay(ev, root + "/in", chunks[:1], 1)
    parsed = lambda: st.parse(st.read_stream(spark, root + "/in", 1)).filter(~F.col("_corrupt")).select("event_id", "event_type")
    st.run_to_parquet(parsed(), root + "/out", root + "/ckpt")
    first = spark.read.parquet(root + "/out").count()
    # more data arrives while the query is down
    for i, c in enumerate(chunks[1:], start=1):
        enc = st.encode(ev).filter((F.col("_ts") >= F.lit(c[0])) & (F.col("_ts") < F.lit(c[1])))
        enc.select("value").coalesce(1).write.mode("overwrite").text(f"{root}/in/chunk={i:04d}")
    st.run_to_parquet(parsed(), root + "/out", root + "/ckpt")
    out = spark.read.parquet(root + "/out")
    assert 0 < first < out.count()
    assert out.count() == out.select("event_id").distinct().count() == ev.count()


def test_malformed_records_go_to_side_output(spark):
    raw = spark.createDataFrame([('{"event_id": "1", "event_type": "session_start", "user_id": "2", "session_id": "s", "ts": "2026-07-01T00:00:00"}',), ("not json",)], "value string")
    p = st.parse(raw)
    assert p.filter(~F.col("_corrupt")).count() == 1
    assert p.filter(F.col("_corrupt")).select("raw").first().raw == "not json"


def test_stream_decisions_equal_batch_decisions(spark):
    """T-10: one batch and four batches give the batch job's decisions."""
    from adlake.plans.q_stream import decide_stream

    cols = ["request_id", "winner", "rung"]
    want = _rows(_run(spark, SF001, "decide_with_fallback"), cols)
    for days, batches in ((30, 1), (8, 4)):
        log = decide_stream(spark, SF001, days)
        assert log.select("batch_id").distinct().count() == batches
        assert _rows(log, cols) == want


def test_declared_stream_features_build(spark):
    """X-02: every declared session feature builds a streaming plan over one
    parsed stream, and each name is in the registry."""
    root = scratch_path(spark, f"specs-{uuid.uuid4().hex}")
    from adlake.sources import tables as tb

    st.write_replay(tb.session_events(spark, SF001), root + "/in", st.day_chunks(config.FIXTURE_START, config.FIXTURE_AS_OF, 30), 1)
    ev = st.parse(st.read_stream(spark, root + "/in", 1)).filter(~F.col("_corrupt"))
    names = {n for n, *_ in config.REGISTRY}
    for spec in st.STREAM_FEATURES:
        df = st.build_stream_feature(ev, spec)
        assert df.isStreaming and spec.name in names


def test_stream_windows_equal_batch_windows(spark):
    """T-04 / T-05: session and tumbling windows from the stream equal the
    batch window aggregates, the last ones too."""
    from adlake.sources import tables as tb

    ev = tb.session_events(spark, SF001)
    known = ev.filter(st.known())
    bs = known.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s")).agg(F.count("*").alias("events"))
    bs = bs.select(
        "user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
        F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events",
    )
    cols = ["user_id", "session_start", "session_end", "events"]
    assert _rows(_run(spark, SF001, "stream_sessions"), cols) == _rows(bs, cols)
    bh = ev.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events"
    )
    cols = ["window_start", "event_type", "events"]
    assert _rows(_run(spark, SF001, "stream_hourly_type_counts"), cols) == _rows(bh, cols)


def test_streamed_sliding_counts_keep_an_event_twice(spark):
    """Every window of a user's events, with a late row inside the delay; the
    plan deals an event to two blocks, not to ten windows."""
    chunks = [[(1, SCREEN, 1, 0), (2, SCREEN, 1, 61), (3, "error", 1, 61)], [(4, SCREEN, 2, 1200)], [(5, SCREEN, 1, 700)], END]
    plans = []

    def build(e):
        out = st.sliding_user_counts(e)
        plans.append(out._jdf.queryExecution().analyzed().toString())
        return out

    got = {(r.user_id, r.window_start): r.events for r in _streamed(spark, chunks, build)}
    want = {}
    for user, s in ((1, 0), (1, 61), (2, 1200), (1, 700)):
        for k in range(10):
            key = (user, T0 + dt.timedelta(seconds=s // 60 * 60 - 60 * k))
            want[key] = want.get(key, 0) + 1
    assert got == want
    expand = [x for x in plans[0].split("\n") if "Expand" in x]
    assert len(expand) == 1 and expand[0].count("named_struct") <= 2, expand


def test_streamed_trailing_counts_read_the_source_once(spark):
    def build(e):
        out = st.trailing_counts(e, SCREEN)
        assert "Join" not in out._jdf.queryExecution().analyzed().toString()
        return out

    got = {r.event_id: r.count_10min for r in _streamed(spark, [[(1, SCREEN, 7, 0), (2, SCREEN, 7, 599), (3, SCREEN, 7, 600)], END], build)}
    assert got == {1: 1, 2: 2, 3: 2}
