"""As-of joins across time buckets (the skew-safe split must not change
results)."""

import datetime as dt

from adlake.operators import asof as ao
from adlake.operators import session_features as sfo

T0 = dt.datetime(2026, 7, 1)


def ev(spark, rows):
    """rows: (event_id, event_type, user_id, campaign_id, seconds after T0)."""
    return spark.createDataFrame(
        [(e, t, u, c, T0 + dt.timedelta(seconds=s)) for e, t, u, c, s in rows],
        "event_id long, event_type string, user_id long, campaign_id long, ts timestamp",
    )


def brute_force(rows, keys, max_age=None):
    out = {}
    for e, t, u, c, s in rows:
        if t != "click":
            continue
        k = (u, c) if keys == 2 else (u,)
        best = None
        for e2, t2, u2, c2, s2 in rows:
            k2 = (u2, c2) if keys == 2 else (u2,)
            if t2 == "impression" and k2 == k and s2 <= s and (best is None or (s2, e2) > (best[1], best[0])):
                best = (e2, s2)
        if best is not None and max_age is not None and s - best[1] > max_age:
            best = None
        out[e] = best[0] if best else None
    return out


def test_attribution_matches_brute_force_across_buckets(spark):
    rows = [
        (1, "impression", 1, 10, 100),
        (2, "click", 1, 10, 3 * 86400 + 5),  # many buckets later, no impression in between
        (3, "impression", 1, 10, 3 * 86400 + 10),
        (4, "click", 1, 10, 3 * 86400 + 10),  # same instant: the impression counts as earlier
        (5, "click", 1, 11, 50),  # other campaign, no impression
        (6, "impression", 2, 10, 3599),
        (7, "click", 2, 10, 3601),  # crosses an hour boundary
        (8, "impression", 2, 11, 7200),
        (9, "click", 2, 10, 90000),  # user-only key picks campaign 11's impression
    ]
    df = ev(spark, rows)
    got = {r.click_id: r.impression_id for r in ao.attribute_clicks(df).collect()}
    assert got == brute_force(rows, 2)
    got_u = {r.click_id: r.impression_id for r in ao.attribute_clicks(df, keys=("user_id",), max_age_seconds=86400).collect()}
    assert got_u == brute_force(rows, 1, 86400)
    # bucket size must not matter
    got_day = {r.click_id: r.impression_id for r in ao.attribute_clicks(df, bucket_seconds=86400).collect()}
    assert got_day == got


def test_trailing_count_across_bucket_edge(spark):
    rows = [(i, "app_screen_view", 1, 0, s) for i, s in enumerate([590, 610, 1195, 1205, 1800], start=1)]
    df = ev(spark, rows).withColumnRenamed("campaign_id", "unused")
    got = {r.event_id: r.count_10min for r in sfo.trailing_count(df, "app_screen_view").collect()}
    want = {}
    for e, _, _, _, s in rows:
        want[e] = sum(1 for _, _, _, _, s2 in rows if s - 600 < s2 <= s)
    assert got == want


def test_latest_within_ttl(spark):
    left = spark.createDataFrame(
        [(1, 7, T0 + dt.timedelta(seconds=1000)), (2, 7, T0 + dt.timedelta(seconds=4000)), (3, 8, T0)],
        "request_id long, user_id long, ts timestamp",
    )
    right = spark.createDataFrame(
        [(7, T0 + dt.timedelta(seconds=10), "food"), (7, T0 + dt.timedelta(seconds=900), "travel")],
        "user_id long, ts timestamp, category string",
    )
    got = {r.request_id: (r.category, r.age_seconds) for r in ao.latest_within(left, right, "user_id", ["category"], 1800).collect()}
    assert got == {1: ("travel", 100.0), 2: (None, None), 3: (None, None)}
    kept = ao.latest_within(left, right, "user_id", ["category"], 1800, keep_left=True)
    assert set(kept.columns) >= {"request_id", "user_id", "ts", "category", "age_seconds"}
