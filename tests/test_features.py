"""Hand-made cases for the batch features, gate and snapshot store
(FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake import config
from adlake.operators import features as ft
from adlake.operators import quality as qc
from adlake.sources import snapshots as ss
from adlake.sources.tables import window_bounds

D = dt.date


def ad_events(spark, rows):
    """rows: (event_id, event_type, user_id, campaign_id, date, hour, category)."""
    data = [
        (eid, et, u, c, dt.datetime.combine(d, dt.time(h)), d, h, cat)
        for eid, et, u, c, d, h, cat in rows
    ]
    return spark.createDataFrame(
        data,
        "event_id long, event_type string, user_id long, campaign_id long, ts timestamp, event_date date, "
        "hour_of_day long, category string",
    )


def test_window_bounds():
    assert window_bounds(D(2026, 7, 18), 7) == (D(2026, 7, 12), D(2026, 7, 18))


def test_ctr_in_window_only(spark):
    ev = ad_events(
        spark,
        [
            (1, "impression", 1, 10, D(2026, 7, 17), 9, "food"),
            (2, "click", 1, 10, D(2026, 7, 17), 9, "food"),
            (3, "impression", 1, 10, D(2026, 6, 1), 9, "food"),
        ],
    )
    out = ft.ctr_overall(ev, D(2026, 7, 18), 7, "user_id", "ctr").collect()
    assert [(r.user_id, r.ctr) for r in out] == [(1, 1.0)]


def test_ctr_by_category_two_categories(spark):
    ev = ad_events(
        spark,
        [
            (1, "impression", 1, 10, D(2026, 7, 17), 9, "food"),
            (2, "click", 1, 10, D(2026, 7, 17), 9, "food"),
            (3, "impression", 1, 11, D(2026, 7, 17), 9, "travel"),
        ],
    )
    got = {r.category: r.ctr for r in ft.ctr_by_category(ev, D(2026, 7, 18), 30).collect()}
    assert got == {"food": 1.0, "travel": 0.0}


def test_spend_yesterday(spark):
    ev = ad_events(
        spark,
        [
            (1, "impression", 1, 10, D(2026, 7, 17), 9, "food"),
            (2, "impression", 2, 10, D(2026, 7, 17), 9, "food"),
            (3, "impression", 2, 11, D(2026, 7, 17), 9, "food"),
        ],
    )
    camps = spark.createDataFrame(
        [(10, "auction", 2.0), (11, "guaranteed", None), (12, "auction", 1.0)], "campaign_id long, demand_type string, bid double"
    )
    got = {r.campaign_id: r.campaign_spend_yesterday for r in ft.spend_yesterday(ev, camps, D(2026, 7, 18)).collect()}
    assert got == {10: 4.0, 11: 0.0, 12: 0.0}


def test_point_in_time_snapshots(spark, tmp_path):
    """A future impression on day 20 must not change the day-15 snapshot."""
    base = [
        (1, "impression", 1, 10, D(2026, 7, 14), 9, "food"),
        (2, "click", 1, 10, D(2026, 7, 14), 9, "food"),
    ]
    future = [(3, "impression", 1, 10, D(2026, 7, 20), 9, "food")]
    ev = ad_events(spark, base + future)
    root = str(tmp_path / "store")
    d15 = ft.ctr_overall(ev, D(2026, 7, 15), 30, "user_id", "user_ctr_30d").withColumn("asof", F.lit(D(2026, 7, 15)))
    ss.write_snapshot(d15, root, "user")
    first = ss.query_as_of(spark, root, "user", D(2026, 7, 15)).collect()[0].user_ctr_30d
    d20 = ft.ctr_overall(ev, D(2026, 7, 20), 30, "user_id", "user_ctr_30d").withColumn("asof", F.lit(D(2026, 7, 20)))
    ss.write_snapshot(d20, root, "user")
    assert first == 1.0
    assert ss.query_as_of(spark, root, "user", D(2026, 7, 15)).collect()[0].user_ctr_30d == 1.0
    assert ss.query_as_of(spark, root, "user", D(2026, 7, 20)).collect()[0].user_ctr_30d == 0.5
    # as of a later day: the whole latest snapshot; before any: none
    assert ss.query_as_of(spark, root, "user", D(2026, 7, 25)).collect()[0].user_ctr_30d == 0.5
    assert ss.query_as_of(spark, root, "user", D(2026, 7, 1)) is None
    dates = sorted(r.asof for r in ss.snapshot_dates(spark, root, "user").collect())
    assert dates == [D(2026, 7, 15), D(2026, 7, 20)]


def test_gate_blocks_poisoned_frame(spark, tmp_path):
    """Half the campaign ids nulled: null-rate gate fails and nothing is written."""
    rows = [(i if i % 2 else None, 0.1) for i in range(10)]
    df = spark.createDataFrame(rows, "campaign_id long, ad_ctr_7d double")
    rep = qc.gate_report(df, "ad_ctr_7d", ["campaign_id", "ad_ctr_7d"], 10)
    root = str(tmp_path / "store")
    with pytest.raises(qc.QualityGateError):
        qc.enforce(rep)
        ss.write_snapshot(df.withColumn("asof", F.lit(D(2026, 7, 1))), root, "ad")
    assert ss.read_entity(spark, root, "ad") is None


def test_gate_thresholds(spark):
    df8 = spark.createDataFrame([(i, 0.1) for i in range(8)], "k long, v double")
    assert qc.gate_report(df8, "j", ["v"], 10).first().row_check_passed  # exactly 80 %
    df7 = spark.createDataFrame([(i, 0.1) for i in range(7)], "k long, v double")
    assert not qc.gate_report(df7, "j", ["v"], 10).first().row_check_passed
    nulls = spark.createDataFrame([(i, None if i == 0 else 0.1) for i in range(20)], "k long, v double")
    assert qc.gate_report(nulls, "j", ["v"], 20).first().null_check_passed  # exactly 5 %
    nulls2 = spark.createDataFrame([(i, None if i < 2 else 0.1) for i in range(20)], "k long, v double")
    assert not qc.gate_report(nulls2, "j", ["v"], 20).first().null_check_passed
    assert qc.gate_report(df7, "j", ["v"], 0).first().row_check_passed  # 0 expected skips


def test_contract_rejects_unregistered_column(spark):
    df = spark.createDataFrame([(1, 0.1)], "campaign_id long, not_a_feature double")
    with pytest.raises(qc.ContractError):
        qc.check_output_contract(df, "campaign_id", ["not_a_feature"], "ad")
    df2 = spark.createDataFrame([(1, 0.1)], "campaign_id long, user_ctr_30d double")
    with pytest.raises(qc.ContractError):
        qc.check_output_contract(df2, "campaign_id", ["user_ctr_30d"], "ad")


def test_memberships_and_reach(spark):
    ctx = spark.createDataFrame(
        [
            (1, "traveler", 0.0, {"travel": 0.10}),
            (2, "traveler", 0.0, {"travel": 0.01}),
            (3, "commuter", 6.0, {}),
            (4, "general", 9.0, {}),
        ],
        "user_id long, segment string, user_rides_per_week double, user_ctr_by_category_30d map<string,double>",
    )
    auds = [config.Audience(n, v, tuple(r)) for n, v, r in config.AUDIENCES]
    mem = ft.memberships(ctx, auds)
    got = {r.user_id: r.audience_memberships for r in mem.collect()}
    assert got == {1: ["frequent_airport_travelers"], 2: [], 3: ["weekday_commuters"], 4: []}
    names = [a.name for a in auds]
    reach = {r.audience: (r.members, r.total_users) for r in ft.audience_reach(mem, names).collect()}
    assert reach == {"frequent_airport_travelers": (1, 4), "weekday_commuters": (1, 4)}
    ov = [(r.audience_a, r.audience_b, r.overlap) for r in ft.audience_overlap(mem, names).collect()]
    assert ov == [("frequent_airport_travelers", "weekday_commuters", 0)]


def test_backfill_equals_daily_runs(spark):
    """The one-pass backfill gives, for every day, what a per-day run gives."""
    rows = []
    eid = 0
    for day in range(1, 15):
        for u in (1, 2):
            eid += 1
            rows.append((eid, "impression", u, 10 + u, D(2026, 7, day), 9, "food"))
            if (day + u) % 3 == 0:
                eid += 1
                rows.append((eid, "click", u, 10 + u, D(2026, 7, day), 10, "food"))
    ev = ad_events(spark, rows)
    users = spark.createDataFrame([(1, D(2026, 1, 1)), (2, D(2026, 7, 5))], "user_id long, created_at date")
    rides = spark.createDataFrame([(1, D(2026, 7, 3))], "user_id long, ride_date date")
    bf = ft.backfill_user(users, ev, rides, D(2026, 7, 5), D(2026, 7, 14))
    got = {(r.user_id, r.asof): (r.user_ctr_30d, r.user_impressions_7d, r.user_rides_per_week, r.user_account_age_days) for r in bf.collect()}
    for day in range(5, 15):
        a = D(2026, 7, day)
        ctr = {r.user_id: r.c for r in ft.ctr_overall(ev, a, 30, "user_id", "c").collect()}
        imp = {r.user_id: r.n for r in ft.impressions_count(ev, a, 7, "user_id", "n").collect()}
        rd = {r.user_id: r.user_rides_per_week for r in ft.rides_count(rides, a, 7).collect()}
        for u, created in ((1, D(2026, 1, 1)), (2, D(2026, 7, 5))):
            assert got[(u, a)] == (ctr.get(u), imp.get(u), rd.get(u), (a - created).days)


def test_one_scan_daily_activity_equals_two_frame_path(spark):
    """The single-scan (views, clicks, purchases) daily aggregate feeds the
    user backfill with exactly what the separate ad-event and ride frames give."""
    from conftest import SF001

    from adlake.sources import tables as tb

    start, end = D(2024, 1, 5), D(2024, 1, 30)
    users, ev, rides = tb.users(spark, SF001), tb.ad_events(spark, SF001, with_category=False), tb.rides(spark, SF001)
    a = ft.backfill_user(users, ev, rides, start, end)
    daily = tb.user_daily_activity(spark, SF001, start - dt.timedelta(days=29), end)
    b = ft.backfill_user(users, ev, rides, start, end, daily=daily)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
