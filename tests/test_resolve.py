"""Feature resolution: validation, session store, precedence, both entities."""

import datetime as dt

import pytest

from adlake.operators import resolve as rs
from adlake.operators import session_features as sfo

T0 = dt.datetime(2026, 7, 2, 12, 0, 0)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def events(spark, rows):
    """rows: (event_id, event_type, user_id, seconds, payload)."""
    data = [(e, t, u, "s", at(s), p) for e, t, u, s, p in rows]
    return spark.createDataFrame(data, "event_id long, event_type string, user_id long, session_id string, ts timestamp, payload map<string,string>")


def requests(spark, rows):
    return spark.createDataFrame([(r, u, at(s)) for r, u, s in rows], "request_id long, user_id long, ts timestamp")


def test_queries_with_wrong_names_fail_as_a_whole():
    rs.validate("user", ["user_ctr_30d", "promos_viewed_10min"])
    with pytest.raises(rs.ResolverError, match="nope"):
        rs.validate("user", ["user_ctr_30d", "nope"])
    with pytest.raises(rs.ResolverError, match="'ad'"):
        rs.validate("user", ["ad_ctr_7d"])


def test_session_values_as_of_requests(spark):
    ev = events(spark, [
        (1, "app_screen_view", 1, 0, {}), (2, "app_screen_view", 1, 500, {}), (3, "app_screen_view", 1, 900, {}),
        (4, "destination_entered", 1, 100, {"category": "food"}), (5, "destination_entered", 1, 200, {"category": "travel"}),
        (6, "promo_viewed", 1, 300, {}), (7, "ride_type_selected", 1, 400, {"ride_type": "shared"}), (8, "error", 2, 900, {}),
    ])
    req = requests(spark, [(1, 1, 900), (2, 1, 1999), (3, 1, 2000), (4, 1, 2699), (5, 1, 2700), (6, 2, 901), (7, 1, -1)])
    got = {r.request_id: r for r in sfo.session_values_at(req, ev).collect()}
    val = lambda r, f: None if got[r][f] is None else (got[r][f]["value"], got[r][f]["age_seconds"])
    # the stored count is that of the event: at 900 the event at 0 is out of (300, 900]
    assert val(1, "user_screens_viewed_10min") == (2, 0.0) and val(2, "user_screens_viewed_10min") == (2, 1099.0)
    assert val(1, "user_current_destination_category") == ("travel", 700.0)
    assert val(2, "user_current_destination_category") == ("travel", 1799.0) and val(3, "user_current_destination_category") is None
    assert val(1, "user_current_ride_type") == ("shared", 500.0) and val(1, "promos_viewed_10min") == (1, 600.0)
    assert val(4, "user_session_active") == (True, 1799.0) and val(5, "user_session_active") is None
    assert all(val(6, f) is None and val(7, f) is None for f in sfo.SESSION_FEATURES)


def test_precedence_status_and_defaults(spark):
    ev = events(spark, [(1, "session_start", 1, 0, {})])
    day = (T0 - dt.timedelta(days=1)).date()
    snap = spark.createDataFrame([(1, day, 0.25, {"food": 0.5})], "user_id long, asof date, user_ctr_30d double, user_ctr_by_category_30d map<string,double>")
    names = ["user_session_active", "user_ctr_30d", "user_ctr_by_category_30d", "user_impressions_7d"]
    got = {(r.request_id, r.feature_name): tuple(r)[3:] for r in rs.resolve_entity(requests(spark, [(1, 1, 4), (2, 1, 6), (3, 9, 4)]), "user", names, snap, ev).collect()}
    assert got[1, "user_session_active"] == ("realtime", "fresh", False, 1.0, None)
    assert got[2, "user_session_active"] == ("realtime", "stale", False, 1.0, None)  # five seconds are the limit
    assert got[1, "user_ctr_30d"] == ("batch", "fresh", False, 0.25, None)
    assert got[1, "user_ctr_by_category_30d"] == ("batch", "fresh", False, None, '{"food":0.500000}')
    assert got[1, "user_impressions_7d"] == ("default", "missing", True, 0.0, None)
    assert got[3, "user_session_active"] == ("default", "missing", True, 0.0, None)
    assert got[3, "user_ctr_by_category_30d"] == ("default", "missing", True, None, "{}")
    ads = spark.createDataFrame([(1, 5, T0), (2, 6, T0)], "request_id long, campaign_id long, ts timestamp")
    snap = spark.createDataFrame([(5, day, 0.5)], "campaign_id long, asof date, ad_ctr_7d double")
    got = {(r.request_id, r.feature_name): (r.entity, r.source, r.value_num) for r in rs.resolve_entity(ads, "ad", ["ad_ctr_7d", "ad_ctr_30d"], snap).collect()}
    assert got == {(1, "ad_ctr_7d"): ("ad", "batch", 0.5), (1, "ad_ctr_30d"): ("ad", "default", 0.0), (2, "ad_ctr_7d"): ("ad", "default", 0.0), (2, "ad_ctr_30d"): ("ad", "default", 0.0)}
