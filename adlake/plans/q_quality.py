"""Named queries: snapshot store, long-form publish, quality and governance."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import account_age_days, assign_arm, in_window
from adlake.functions.scalar import lit_date as fx_date
from adlake.operators import features as ft
from adlake.operators import quality as qc
from adlake.plans.catalog import query
from adlake.plans.q_features import AS_OF, BACKFILL_END, BACKFILL_START, D, RULE_CATS, W, _d
from adlake.plans.sql_views import with_views as V
from adlake.session import scratch_path
from adlake.sources import publish as pb
from adlake.sources import snapshots as ss
from adlake.sources import tables as tb

AD_COLS = ["ad_ctr_7d", "ad_ctr_30d", "ad_impressions_7d", "campaign_spend_yesterday"]
USER_NUM = ["user_ctr_30d", "user_impressions_7d", "user_rides_per_week", "user_account_age_days"]


def _store(spark) -> str:
    return scratch_path(spark, f"feature-store-{uuid.uuid4().hex}")


_AD_SNAPSHOT_SQL = """SELECT c.campaign_id,
      CASE WHEN a.imps7 > 0 THEN a.clicks7 / a.imps7 END AS ad_ctr_7d,
      CASE WHEN a.imps30 > 0 THEN a.clicks30 / a.imps30 END AS ad_ctr_30d,
      CASE WHEN a.imps7 > 0 THEN a.imps7 END AS ad_impressions_7d,
      CASE WHEN c.demand_type = 'auction' THEN coalesce(a.imps_y, 0) * c.bid ELSE 0.0 END AS campaign_spend_yesterday
    FROM campaigns c LEFT JOIN (
      SELECT campaign_id,
        count(*) FILTER (WHERE event_type = 'impression') AS imps30,
        count(*) FILTER (WHERE event_type = 'click') AS clicks30,
        count(*) FILTER (WHERE event_type = 'impression' AND {w7}) AS imps7,
        count(*) FILTER (WHERE event_type = 'click' AND {w7}) AS clicks7,
        count(*) FILTER (WHERE event_type = 'impression' AND event_date = DATE '{y}') AS imps_y
      FROM ad_events WHERE {w30} GROUP BY campaign_id) a ON a.campaign_id = c.campaign_id"""


def ad_snapshot_sql(as_of: dt.date) -> str:
    w = lambda n: f"event_date BETWEEN DATE '{as_of - dt.timedelta(days=n - 1)}' AND DATE '{as_of}'"
    return _AD_SNAPSHOT_SQL.format(w7=w(7), w30=w(30), y=as_of - dt.timedelta(days=1))


def _write_backfilled_ads(spark, sf) -> str:
    root = _store(spark)
    bf = ft.backfill_ad(tb.ad_events(spark, sf, with_category=False), tb.campaigns(spark, sf), BACKFILL_START, BACKFILL_END)
    ss.write_snapshot(bf, root, "ad")
    return root


def shown_in(spark, sf, key: str, as_of: dt.date, window_days: int) -> int:
    """Q-02 for the write path: entities with impressions in a job's window
    (most customers and parts have no events; FIXTURES.md, trap 2)."""
    ev = tb.ad_events(spark, sf, with_category=False).filter(ft.IMP() & in_window("event_date", as_of, window_days))
    return ev.agg(F.count_distinct(key).alias("n")).first()["n"]


def user_jobs(spark, sf, as_of: dt.date) -> list[pb.Job]:
    """The six user jobs of a day."""
    ev, rides, users = tb.ad_events(spark, sf), tb.rides(spark, sf), tb.users(spark, sf)
    month, week = (shown_in(spark, sf, "user_id", as_of, n) for n in (30, 7))
    mem = ft.memberships(ft.audience_context(users, ev, rides, as_of), config.fixture_audiences())
    age = users.select("user_id", account_age_days(F.col("created_at"), fx_date(as_of)).alias("user_account_age_days"))
    return [
        pb.Job("user_ctr", ft.ctr_overall(ev, as_of, 30, "user_id", "user_ctr_30d"), month),
        pb.Job("user_impressions", ft.impressions_count(ev, as_of, 7, "user_id", "user_impressions_7d"), week),
        pb.Job("user_rides", ft.rides_count(rides, as_of, 7), 0),
        pb.Job("user_account_age", age, users.count()),
        pb.Job("user_category_ctr", ft.ctr_by_category_map(ev, as_of, 30), month),
        pb.Job("user_audiences", mem, users.count()),
    ]


def ad_jobs(spark, sf, as_of: dt.date) -> list[pb.Job]:
    """The four ad jobs of a day."""
    ev, camps = tb.ad_events(spark, sf, with_category=False), tb.campaigns(spark, sf)
    month, week = (shown_in(spark, sf, "campaign_id", as_of, n) for n in (30, 7))
    return [
        pb.Job("ad_ctr_week", ft.ctr_overall(ev, as_of, 7, "campaign_id", "ad_ctr_7d"), week),
        pb.Job("ad_ctr_month", ft.ctr_overall(ev, as_of, 30, "campaign_id", "ad_ctr_30d"), month),
        pb.Job("ad_impressions", ft.impressions_count(ev, as_of, 7, "campaign_id", "ad_impressions_7d"), week),
        pb.Job("ad_spend", ft.spend_yesterday(ev, camps, as_of).select("campaign_id", "campaign_spend_yesterday"), camps.count()),
    ]


@query("write_feature_snapshot", V(ad_snapshot_sql(AS_OF), "ad_events"))
def write_feature_snapshot(spark, sf):
    """S-02: stage, gate, publish the ads' day; the result is the read-back
    partition."""
    root = _store(spark)
    pb.publish_day(spark, root, "ad", ad_jobs(spark, sf, AS_OF), AS_OF)
    return ss.query_as_of(spark, root, "ad", AS_OF).select("campaign_id", *AD_COLS)


@query("snapshot_after_rejected_day", V(ad_snapshot_sql(AS_OF), "ad_events"))
def snapshot_after_rejected_day(spark, sf):
    """S-02 / Q-01: the published day after a second run of it whose events
    had lost half of their campaign ids: the gate refuses it, and the
    snapshot stays as it was."""
    root = _store(spark)
    jobs = ad_jobs(spark, sf, AS_OF)
    pb.publish_day(spark, root, "ad", jobs, AS_OF)
    lost = F.when(F.pmod(F.xxhash64("campaign_id"), F.lit(2)) == 0, F.col("campaign_id"))
    for job in jobs:
        job.frame = job.frame.withColumn("campaign_id", lost)
    try:
        pb.publish_day(spark, root, "ad", jobs, AS_OF)
    except qc.QualityGateError:
        return ss.query_as_of(spark, root, "ad", AS_OF).select("campaign_id", *AD_COLS)
    raise AssertionError("the gate let a poisoned day pass")


def _user_day_sql() -> str:
    from adlake.plans.q_models import feature_ctes

    return V(
        """SELECT u.user_id, u.user_ctr_30d, u.user_impressions_7d, u.user_rides_per_week, u.user_account_age_days,
             coalesce(array_to_string(m.a, ','), '') AS audience_memberships, coalesce(k.n, 0) AS categories
           FROM puser u LEFT JOIN (SELECT user_id, list(audience ORDER BY audience_order) AS a FROM mem_long GROUP BY user_id) m
             ON m.user_id = u.user_id
           LEFT JOIN (SELECT user_id, count(*) AS n FROM pcat GROUP BY user_id) k ON k.user_id = u.user_id""",
        "users", "user_segments", "ad_events", "rides", "campaigns",
        extra=membership_ctes(AS_OF, 1) + feature_ctes(AS_OF, 1, "p"),
    )


@query("published_user_features")
def published_user_features(spark, sf):
    """J-02 + S-02: all six user frames of a day, merged, gated and read back."""
    root = _store(spark)
    pb.publish_day(spark, root, "user", user_jobs(spark, sf, AS_OF), AS_OF)
    return ss.query_as_of(spark, root, "user", AS_OF).select(
        "user_id", *USER_NUM, F.array_join("audience_memberships", ",").alias("audience_memberships"),
        F.greatest(F.coalesce(F.size("user_ctr_by_category_30d"), F.lit(0)), F.lit(0)).cast("long").alias("categories"),
    )


@query("published_membership_versions")
def published_membership_versions(spark, sf):
    """S-08: two published days; a day that is published again is replaced."""
    root = _store(spark)
    for day in (AS_OF - dt.timedelta(days=1), AS_OF, AS_OF):
        jobs = [j for j in user_jobs(spark, sf, day) if j.name == "user_audiences"]
        pb.publish_day(spark, root, "user", jobs, day)
    return pb.memberships(spark, root).select("user_id", "audience", "definition_version", F.col("asof").alias("as_of_date"))


@query(
    "snapshot_dates",
    f"""SELECT CAST(DATE '{BACKFILL_START}' + CAST(i AS INTEGER) AS DATE) AS asof
        FROM range(0, {(BACKFILL_END - BACKFILL_START).days + 1}) t(i)""",
)
def snapshot_dates(spark, sf):
    """S-03: distinct partition dates after a backfill write."""
    root = _write_backfilled_ads(spark, sf)
    return ss.snapshot_dates(spark, root, "ad")


AS_OF_READ = AS_OF + dt.timedelta(days=6)


@query("features_as_of", V(ad_snapshot_sql(AS_OF), "ad_events"))
def features_as_of(spark, sf):
    """J-06: read as of a day after the last partition -> the whole latest
    snapshot (largest asof <= D), partition-pruned."""
    root = _write_backfilled_ads(spark, sf)
    return ss.query_as_of(spark, root, "ad", AS_OF_READ).select("campaign_id", *AD_COLS)


@query(
    "publish_features_long",
    V(
        " UNION ALL ".join(
            f"""SELECT 'ad#' || CAST(campaign_id AS VARCHAR) AS entity_key, '{c}' AS feature_name,
                 CAST({c} AS DOUBLE) AS value FROM snap WHERE {c} IS NOT NULL"""
            for c in AD_COLS
        ),
        "ad_events",
        extra=[("snap", ad_snapshot_sql(AS_OF))],
    ),
)
def publish_features_long(spark, sf):
    """S-07: published long-form items (entity_key, feature_name, value JSON,
    computed_at), null values skipped; value parsed back for the check."""
    root = _store(spark)
    pb.publish_day(spark, root, "ad", ad_jobs(spark, sf, AS_OF), AS_OF)
    long = pb.items(spark, root, "ad", AS_OF)
    return long.select("entity_key", "feature_name", F.col("value_json").cast("double").alias("value"))


MEMB_START = config.FIXTURE_START


def membership_ctes(start: dt.date, n_days: int) -> list[tuple[str, str]]:
    """DuckDB CTEs ending in mem_long(user_id, audience, definition_version,
    audience_order, as_of_date) for n_days days from start."""
    auds = config.fixture_audiences()
    a_sql = []
    for order, a in enumerate(auds):
        preds = []
        for f, op, v in a.rules:
            sym = {"eq": "=", "ne": "<>", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}[op]
            col = ("ctr_" + f.split(".", 1)[1].lower()) if f.startswith("user_ctr_by_category_30d.") else f
            val = f"'{v}'" if isinstance(v, str) else repr(float(v))
            preds.append(f"{col} {sym} {val}")
        a_sql.append(
            f"SELECT user_id, '{a.name}' AS audience, CAST({a.version} AS BIGINT) AS definition_version, "
            f"{order} AS audience_order, as_of_date FROM mctx WHERE {' AND '.join(preds)}"
        )
    cats = RULE_CATS
    cat_cols = ", ".join(
        f"coalesce(max(ctr) FILTER (WHERE category = '{c}'), 0.0) AS ctr_{c.lower()}" for c in cats
    )
    days = f"""SELECT CAST(DATE '{start}' + CAST(i AS INTEGER) AS DATE) AS as_of_date FROM range(0, {n_days}) t(i)"""
    return [
        ("mdays", days),
        (
            "mcatctr",
            """SELECT e.user_id, d.as_of_date, e.category,
             count(*) FILTER (WHERE e.event_type = 'click') / count(*) FILTER (WHERE e.event_type = 'impression') AS ctr
           FROM ad_events e JOIN mdays d ON e.event_date BETWEEN d.as_of_date - 29 AND d.as_of_date
           GROUP BY e.user_id, d.as_of_date, e.category HAVING count(*) FILTER (WHERE e.event_type = 'impression') > 0""",
        ),
        ("mcatwide", f"SELECT user_id, as_of_date, {cat_cols} FROM mcatctr GROUP BY user_id, as_of_date"),
        (
            "mr7",
            """SELECT r.user_id, d.as_of_date, CAST(count(*) AS DOUBLE) AS user_rides_per_week
           FROM rides r JOIN mdays d ON r.ride_date BETWEEN d.as_of_date - 6 AND d.as_of_date GROUP BY r.user_id, d.as_of_date""",
        ),
        (
            "mctx",
            "SELECT u.user_id, u.segment, d.as_of_date, coalesce(r.user_rides_per_week, 0.0) AS user_rides_per_week, "
            + ", ".join(f"coalesce(w.ctr_{c.lower()}, 0.0) AS ctr_{c.lower()}" for c in cats)
            + """ FROM user_segments u CROSS JOIN mdays d
             LEFT JOIN mr7 r ON r.user_id = u.user_id AND r.as_of_date = d.as_of_date
             LEFT JOIN mcatwide w ON w.user_id = u.user_id AND w.as_of_date = d.as_of_date""",
        ),
        ("mem_long", " UNION ALL ".join(a_sql)),
    ]


def _memb_hist_sql() -> str:
    return V(
        "SELECT user_id, audience, definition_version, as_of_date FROM mem_long",
        "user_segments",
        "ad_events",
        "rides",
        extra=membership_ctes(MEMB_START, (AS_OF - MEMB_START).days + 1),
    )


@query("audience_membership_history", _memb_hist_sql())
def audience_membership_history(spark, sf):
    """S-08: versioned long membership table for every day of the calendar
    (written by asof partition; the version history is its distinct
    (audience, definition_version, asof) projection)."""
    out = ft.memberships_backfill(
        tb.user_segments(spark, sf), tb.ad_events(spark, sf), tb.rides(spark, sf), MEMB_START, AS_OF, config.fixture_audiences()
    )
    return out.drop("audience_order").withColumnRenamed("asof", "as_of_date")


# ----------------------------------------------------------------- gate

_GATE_JOBS_SQL = [
    ("user_ctr_30d", "user_id", 30, "ctr"),
    ("user_impressions_7d", "user_id", 7, "imps"),
    ("ad_ctr_7d", "campaign_id", 7, "ctr"),
    ("ad_ctr_30d", "campaign_id", 30, "ctr"),
    ("ad_impressions_7d", "campaign_id", 7, "imps"),
]


def _expected_sql(key: str, window: int) -> str:
    if key == "user_id":
        return "(SELECT count(DISTINCT user_id) FROM ad_events)"
    return f"""(SELECT count(*) FROM campaigns WHERE status = 'active' AND flight_start <= DATE '{D}'
               AND flight_end >= DATE '{_d(window - 1)}')"""


def _gate_sql() -> str:
    parts = []
    for job, key, window, kind in _GATE_JOBS_SQL:
        having = "HAVING count(*) FILTER (WHERE event_type = 'impression') > 0" if kind == "ctr" else ""
        where = "" if kind == "ctr" else "AND event_type = 'impression'"
        parts.append(
            f"""SELECT '{job}' AS job, '{job}' AS feature, count(*) AS rows, CAST({_expected_sql(key, window)} AS BIGINT) AS expected,
                CAST(0 AS BIGINT) AS null_count
            FROM (SELECT {key} FROM ad_events WHERE {W(window)} {where} GROUP BY {key} {having}) t"""
        )
    body = " UNION ALL ".join(parts)
    return V(
        f"""SELECT *, (expected = 0 OR CAST(rows AS DOUBLE) / expected >= 0.8) AS row_check_passed,
              (rows = 0 OR CAST(null_count AS DOUBLE) / rows <= 0.05) AS null_check_passed
            FROM ({body}) g""",
        "ad_events",
    )


def _expected_counts(spark, sf) -> dict[str, int]:
    """Q-02: expected populations from one small aggregate each: users seen
    in events (not all customers; fixture trap 2) and campaigns eligible in
    each window."""
    ev = tb.ad_events(spark, sf, with_category=False)
    users = ev.agg(F.count_distinct("user_id").alias("n")).first()["n"]
    c = tb.campaigns(spark, sf).filter(F.col("status") == "active")
    row = c.agg(
        *[
            F.count_if(
                (F.col("flight_start") <= F.lit(AS_OF)) & (F.col("flight_end") >= F.lit(AS_OF - dt.timedelta(days=w - 1)))
            ).alias(f"w{w}")
            for w in (7, 30)
        ]
    ).first()
    return {"user": users, "ad7": row["w7"], "ad30": row["w30"]}


@query("quality_gate_report", _gate_sql())
def quality_gate_report(spark, sf):
    """Q-01: the gate report of the windowed feature jobs."""
    exp = _expected_counts(spark, sf)
    ev = tb.ad_events(spark, sf, with_category=False)
    frames = [
        (ft.ctr_overall(ev, AS_OF, 30, "user_id", "user_ctr_30d"), "user_ctr_30d", exp["user"]),
        (ft.impressions_count(ev, AS_OF, 7, "user_id", "user_impressions_7d"), "user_impressions_7d", exp["user"]),
        (ft.ctr_overall(ev, AS_OF, 7, "campaign_id", "ad_ctr_7d"), "ad_ctr_7d", exp["ad7"]),
        (ft.ctr_overall(ev, AS_OF, 30, "campaign_id", "ad_ctr_30d"), "ad_ctr_30d", exp["ad30"]),
        (ft.impressions_count(ev, AS_OF, 7, "campaign_id", "ad_impressions_7d"), "ad_impressions_7d", exp["ad7"]),
    ]
    out = None
    for df, name, e in frames:
        r = qc.gate_report(df, name, [name], e)
        out = r if out is None else out.unionByName(r)
    return out


@query(
    "expected_entity_count",
    V(
        f"""SELECT 'user' AS population, CAST(count(DISTINCT user_id) AS BIGINT) AS expected FROM ad_events
        UNION ALL SELECT 'ad_catalog', count(*) FROM campaigns
        UNION ALL SELECT 'ad_window_7', {_expected_sql('campaign_id', 7)}
        UNION ALL SELECT 'ad_window_30', {_expected_sql('campaign_id', 30)}""",
        "ad_events",
    ),
)
def expected_entity_count(spark, sf):
    """Q-02 as a table: one aggregate per source, no driver loop."""
    ev = tb.ad_events(spark, sf, with_category=False)
    u = ev.agg(F.lit("user").alias("population"), F.count_distinct("user_id").alias("expected"))
    c = tb.campaigns(spark, sf)
    act = F.col("status") == "active"
    cs = c.agg(
        F.count("*").alias("ad_catalog"),
        *[
            F.count_if(act & (F.col("flight_start") <= F.lit(AS_OF)) & (F.col("flight_end") >= F.lit(AS_OF - dt.timedelta(days=w - 1)))).alias(f"ad_window_{w}")
            for w in (7, 30)
        ],
    )
    st = F.array(*[F.struct(F.lit(n).alias("population"), F.col(n).alias("expected")) for n in ("ad_catalog", "ad_window_7", "ad_window_30")])
    return u.unionByName(cs.select(F.explode(st).alias("s")).select("s.population", "s.expected"))


@query(
    "contract_violations",
    V(
        f"""SELECT 'ad_snapshot' AS job, f.feature, (SELECT count(*) FILTER (WHERE campaign_id IS NULL) FROM snap) AS null_ids,
           (SELECT count(campaign_id) - count(DISTINCT campaign_id) FROM snap) AS duplicate_ids,
           CASE f.feature
             WHEN 'ad_ctr_7d' THEN (SELECT count(*) FILTER (WHERE ad_ctr_7d < 0) FROM snap)
             WHEN 'ad_ctr_30d' THEN (SELECT count(*) FILTER (WHERE ad_ctr_30d < 0) FROM snap)
             WHEN 'ad_impressions_7d' THEN (SELECT count(*) FILTER (WHERE ad_impressions_7d < 0) FROM snap)
             ELSE (SELECT count(*) FILTER (WHERE campaign_spend_yesterday < 0) FROM snap) END AS out_of_range
        FROM (VALUES ('ad_ctr_7d'), ('ad_ctr_30d'), ('ad_impressions_7d'), ('campaign_spend_yesterday')) f(feature)""",
        "ad_events",
        extra=[("snap", ad_snapshot_sql(AS_OF))],
    ),
)
def contract_violations(spark, sf):
    """Q-03: plan-time column contract + one data pass."""
    snap = ft.ad_snapshot(tb.ad_events(spark, sf, with_category=False), tb.campaigns(spark, sf), AS_OF)
    qc.check_output_contract(snap, "campaign_id", AD_COLS, "ad")
    return qc.contract_violations(snap, "ad_snapshot", "campaign_id", {c: (0, None) for c in AD_COLS})


PIT_DAY = AS_OF - dt.timedelta(days=10)


_PIT_JOBS = {
    "user_ctr_30d": ("user_id", 30, "count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression')"),
    "user_impressions_7d": ("user_id", 7, "count(*) FILTER (WHERE event_type = 'impression')"),
    "ad_ctr_7d": ("campaign_id", 7, "count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression')"),
    "ad_ctr_30d": ("campaign_id", 30, "count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression')"),
    "ad_impressions_7d": ("campaign_id", 7, "count(*) FILTER (WHERE event_type = 'impression')"),
}


def _pit_sql(feature: str) -> str:
    """The feature from the whole table and from the table up to the day."""
    key, w, value = _PIT_JOBS[feature]
    one = f"""SELECT {key} AS id, {value} AS v FROM {{source}}
      WHERE event_date BETWEEN DATE '{PIT_DAY - dt.timedelta(days=w - 1)}' AND DATE '{PIT_DAY}'
      GROUP BY {key} HAVING count(*) FILTER (WHERE event_type = 'impression') > 0"""
    a, b = one.format(source="ad_events"), one.format(source=f"(SELECT * FROM ad_events WHERE event_date <= DATE '{PIT_DAY}')")
    return f"""SELECT '{feature}' AS feature, count(a.id) AS rows_full, count(b.id) AS rows_truncated,
      count(*) FILTER (WHERE a.v IS DISTINCT FROM b.v) AS rows_differing FROM ({a}) a FULL JOIN ({b}) b ON a.id = b.id"""


@query("pit_leak_check", V(" UNION ALL ".join(_pit_sql(f) for f in _PIT_JOBS), "ad_events"))
def pit_leak_check(spark, sf):
    """Q-04: a past day of the one-pass backfill, which reads later events as
    well, against the day's own jobs on the table cut at that day; a feature
    that saw the future would differ."""
    ev, users, camps = tb.ad_events(spark, sf, with_category=False), tb.users(spark, sf), tb.campaigns(spark, sf)
    cut = ev.filter(F.col("event_date") <= F.lit(PIT_DAY))
    full = {
        "user_id": ft.backfill_user(users, ev, tb.rides(spark, sf), PIT_DAY, AS_OF),
        "campaign_id": ft.backfill_ad(ev, camps, PIT_DAY, AS_OF),
    }
    out = None
    for f, (key, w, _) in _PIT_JOBS.items():
        own = ft.ctr_overall(cut, PIT_DAY, w, key, "b") if "ctr" in f else ft.impressions_count(cut, PIT_DAY, w, key, "b")
        seen = full[key].filter((F.col("asof") == F.lit(PIT_DAY)) & F.col(f).isNotNull()).select(key, F.col(f).alias("a"))
        r = seen.join(own, key, "full").agg(
            F.lit(f).alias("feature"), F.count("a").alias("rows_full"), F.count("b").alias("rows_truncated"),
            F.count_if(~F.equal_null(F.col("a"), F.col("b"))).alias("rows_differing"),
        )
        out = r if out is None else out.unionByName(r)
    return out


@query(
    "arm_balance",
    V(
        """SELECT count(*) AS users, count(*) FILTER (WHERE arm = 'control') AS control_users,
             count(*) FILTER (WHERE arm = 'control') / count(*) AS control_share,
             (count(*) FILTER (WHERE arm = 'control') / count(*)) BETWEEN 0.4 AND 0.6 AS balanced
           FROM (SELECT DISTINCT user_id,
                   CASE WHEN (('0x' || right(sha256('phase5-ab-v1:' || CAST(user_id AS VARCHAR)), 1))::INTEGER) % 2 = 0
                        THEN 'control' ELSE 'treatment' END AS arm FROM users) t""",
        "users",
    ),
)
def arm_balance(spark, sf):
    """Q-06: sample-ratio check of the hash split over all users."""
    u = tb.users(spark, sf).select("user_id", assign_arm(F.col("user_id")).alias("experiment_arm"))
    return qc.arm_balance(u)
