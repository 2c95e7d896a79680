"""Named queries: feature resolution, request validation, parity (E-*)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from adlake import config
from adlake.operators import features as ft
from adlake.operators import resolve as rs
from adlake.operators import training as tr
from adlake.plans.catalog import query
from adlake.plans.q_features import AS_OF
from adlake.plans.q_models import feature_ctes
from adlake.plans.q_quality import membership_ctes
from adlake.plans.sql_views import with_views as V
from adlake.session import scratch_path
from adlake.sources import snapshots as ss
from adlake.sources import tables as tb

START = config.FIXTURE_START - dt.timedelta(days=1)
END = AS_OF - dt.timedelta(days=1)
N = (END - START).days + 1
USER_NUM = ["user_ctr_30d", "user_impressions_7d", "user_rides_per_week", "user_account_age_days"]
USER_FEATURES = [n for n, e, *_ in config.REGISTRY if e == "user"]
AD_FEATURES = [n for n, e, *_ in config.REGISTRY if e == "ad"]
KNOWN_SQL = ", ".join(f"'{t}'" for t in config.KNOWN_EVENT_TYPES)


def daily_user_snapshot(spark, sf, start=START, end=END):
    """Every user x day snapshot with all user features (wide): the numeric
    backfill joined once with the per-day context (memberships + category
    CTR map, computed in one exploded pass)."""
    ev = tb.ad_events(spark, sf)
    daily = tb.user_daily_activity(spark, sf, start - dt.timedelta(days=29), end)
    ub = ft.backfill_user(tb.users(spark, sf), ev, tb.rides(spark, sf), start, end, daily=daily)
    ctx = ft.membership_context(
        tb.user_segments(spark, sf), ev, tb.rides(spark, sf), start, end, config.fixture_audiences(), with_inputs=True
    ).drop("segment")
    return ub.join(ctx, ["user_id", "asof"], "left").withColumn(
        "audience_memberships", F.coalesce("audience_memberships", F.array().cast("array<string>"))
    )


def written_snapshots(spark, sf, start=START, end=END):
    """Daily snapshots of both entities in a feature store; returns its root."""
    root = scratch_path(spark, f"feature-store-{uuid.uuid4().hex}")
    ss.write_snapshot(daily_user_snapshot(spark, sf, start, end), root, "user")
    ad = ft.backfill_ad(tb.ad_events(spark, sf, with_category=False), tb.campaigns(spark, sf), start, end)
    ss.write_snapshot(ad, root, "ad")
    return root


def _sla(name):
    return {n: s for n, _, _, _, s, _ in config.REGISTRY}[name]


def _resolve_sql() -> str:
    parts = []
    for f in USER_NUM:
        default = "0.0"
        parts.append(
            f"""SELECT r.request_id, '{f}' AS feature_name,
                 CASE WHEN u.{f} IS NOT NULL THEN 'batch' ELSE 'default' END AS source,
                 CASE WHEN u.{f} IS NOT NULL THEN (CASE WHEN r.age_b <= {_sla(f)} THEN 'fresh' ELSE 'stale' END) ELSE 'missing' END AS freshness_status,
                 u.{f} IS NULL AS default_substituted,
                 CAST(coalesce(u.{f}, {default}) AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_text
               FROM rq r LEFT JOIN guser u ON u.user_id = r.user_id AND u.as_of_date = r.request_date - 1"""
        )
    parts.append(
        f"""SELECT r.request_id, 'audience_memberships', 'batch',
             CASE WHEN r.age_b <= {_sla('audience_memberships')} THEN 'fresh' ELSE 'stale' END, false,
             CAST(NULL AS DOUBLE), coalesce(array_to_string(m.audience_memberships, ','), '')
           FROM rq r LEFT JOIN mem m ON m.user_id = r.user_id AND m.as_of_date = r.request_date - 1"""
    )
    parts.append(
        f"""SELECT r.request_id, 'user_ctr_by_category_30d',
             CASE WHEN k.user_id IS NOT NULL THEN 'batch' ELSE 'default' END,
             CASE WHEN k.user_id IS NOT NULL THEN (CASE WHEN r.age_b <= {_sla('user_ctr_by_category_30d')} THEN 'fresh' ELSE 'stale' END) ELSE 'missing' END,
             k.user_id IS NULL, CAST(NULL AS DOUBLE), coalesce(k.j, '{{}}')
           FROM rq r LEFT JOIN (SELECT user_id, as_of_date,
             '{{' || string_agg('"' || category || '":' || printf('%.6f', cat_ctr), ',' ORDER BY category) || '}}' AS j
             FROM gcat GROUP BY user_id, as_of_date) k ON k.user_id = r.user_id AND k.as_of_date = r.request_date - 1"""
    )
    ttl = config.SESSION_TTL_SECONDS
    for f, cte, num, text in (
        ("user_session_active", "act", "CASE WHEN a.age < {t} THEN 1.0 ELSE 0.0 END", "CAST(NULL AS VARCHAR)"),
        ("user_current_destination_category", "dst", "CAST(NULL AS DOUBLE)", "CASE WHEN a.age < {t} THEN a.v ELSE '' END"),
        ("user_current_ride_type", "rid", "CAST(NULL AS DOUBLE)", "CASE WHEN a.age < {t} THEN a.v ELSE '' END"),
        ("user_screens_viewed_10min", "scr", "CASE WHEN a.age < {t} THEN CAST(a.v AS DOUBLE) ELSE 0.0 END", "CAST(NULL AS VARCHAR)"),
        ("promos_viewed_10min", "pro", "CASE WHEN a.age < {t} THEN CAST(a.v AS DOUBLE) ELSE 0.0 END", "CAST(NULL AS VARCHAR)"),
    ):
        parts.append(
            f"""SELECT r.request_id, '{f}',
                 CASE WHEN a.age < {ttl} THEN 'realtime' ELSE 'default' END,
                 CASE WHEN a.age < {ttl} THEN (CASE WHEN a.age <= {_sla(f)} THEN 'fresh' ELSE 'stale' END) ELSE 'missing' END,
                 NOT coalesce(a.age < {ttl}, false), {num.format(t=ttl)}, {text.format(t=ttl)}
               FROM rq r LEFT JOIN {cte} a ON a.request_id = r.request_id"""
        )
    user = " UNION ALL ".join(parts)
    ads = " UNION ALL ".join(
        f"""SELECT r.request_id, '{f}' AS feature_name,
             CASE WHEN a.{f} IS NOT NULL THEN 'batch' ELSE 'default' END AS source,
             CASE WHEN a.{f} IS NOT NULL THEN (CASE WHEN r.age_b <= {_sla(f)} THEN 'fresh' ELSE 'stale' END) ELSE 'missing' END AS freshness_status,
             a.{f} IS NULL AS default_substituted, CAST(coalesce(a.{f}, 0) AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_text
           FROM rq r JOIN ad_events e ON e.event_id = r.request_id
           LEFT JOIN gad a ON a.campaign_id = e.campaign_id AND a.as_of_date = r.request_date - 1"""
        for f in AD_FEATURES
    )

    def last_write(value: str, kind: str) -> str:
        return f"""SELECT r.request_id, (epoch_us(r.ts) - epoch_us(e.ts)) / 1000000.0 AS age, e.v FROM requests r
                   ASOF LEFT JOIN (SELECT user_id, ts, {value} AS v FROM session_events WHERE event_type {kind}) e
                   ON r.user_id = e.user_id AND r.ts >= e.ts"""

    trailing = """count(*) OVER (PARTITION BY user_id ORDER BY ts
                   RANGE BETWEEN INTERVAL 599999999 MICROSECONDS PRECEDING AND CURRENT ROW)"""
    extra = (
        membership_ctes(START, N)
        + [("mem", "SELECT user_id, as_of_date, list(audience ORDER BY audience_order) AS audience_memberships FROM mem_long GROUP BY user_id, as_of_date")]
        + feature_ctes(START, N, "g")
        + [
            (
                "rq",
                "SELECT request_id, user_id, ts, request_date, (epoch_us(ts) - epoch_us(CAST(request_date AS TIMESTAMP))) / 1000000.0 AS age_b FROM requests",
            ),
            ("act", last_write("true", f"IN ({KNOWN_SQL})")),
            ("dst", last_write("category", "= 'destination_entered'")),
            ("rid", last_write("ride_type", "= 'ride_type_selected'")),
            ("scr", last_write(trailing, "= 'app_screen_view'")),
            ("pro", last_write(trailing, "= 'promo_viewed'")),
        ]
    )
    body = f"SELECT *, 'user' AS entity FROM ({user}) UNION ALL SELECT *, 'ad' FROM ({ads})"
    return V(body, "requests", "session_events", "ad_events", "rides", "users", "user_segments", "campaigns", extra=extra)


@query("resolve_features", _resolve_sql())
def resolve_features(spark, sf):
    """E-03 (+ E-01, E-02, F-13): every request with all 11 user features of
    its user and all 4 ad features of its event's campaign, resolved real-time
    > batch > default with a status.  The batch side reads a written feature
    store; map values are compared with six digits."""
    root = written_snapshots(spark, sf)
    req = tb.requests(spark, sf).select("request_id", "user_id", "ts")
    user = rs.resolve_entity(req, "user", USER_FEATURES, ss.read_entity(spark, root, "user"), tb.session_events(spark, sf))
    shown = tb.ad_events(spark, sf, with_category=False).filter(ft.IMP())
    shown = shown.select(F.col("event_id").alias("request_id"), "campaign_id", "ts")
    return user.unionByName(rs.resolve_entity(shown, "ad", AD_FEATURES, ss.read_entity(spark, root, "ad")))


def _feature_requests(spark, sf):
    """Per request: the arm's model feature list (minus request-time
    hour_of_day) asked on the user entity - the model's ad and cross
    features are what validation must reject."""
    from adlake.functions.scalar import assign_arm

    req = tb.requests(spark, sf).select("request_id", "user_id")
    arm = assign_arm(F.col("user_id"))
    v1 = F.array(*[F.lit(f) for f in config.V1_FEATURES if f != "hour_of_day"])
    v2 = F.array(*[F.lit(f) for f in config.V2_FEATURES if f != "hour_of_day"])
    return req.select(
        "request_id", F.lit("user").alias("entity"), F.explode(F.when(arm == "control", v1).otherwise(v2)).alias("feature_name")
    )


_ARM_SQL = """CASE WHEN (('0x' || right(sha256('phase5-ab-v1:' || CAST(user_id AS VARCHAR)), 1))::INTEGER) % 2 = 0
   THEN 'control' ELSE 'treatment' END"""


def _invalid_sql() -> str:
    reg = {n: e for n, e, *_ in config.REGISTRY}
    rows = []
    for arm, feats in (("control", config.V1_FEATURES), ("treatment", config.V2_FEATURES)):
        for f in feats:
            if f == "hour_of_day":
                continue
            if f not in reg:
                rows.append((arm, f, "unregistered"))
            elif reg[f] != "user":
                rows.append((arm, f, "wrong_entity"))
    vals = ", ".join(f"('{a}', '{f}', '{r}')" for a, f, r in rows)
    return V(
        f"""SELECT q.request_id, 'user' AS entity, b.feature_name, b.reason
            FROM (SELECT request_id, {_ARM_SQL} AS arm FROM requests) q
            JOIN (VALUES {vals}) b(arm, feature_name, reason) ON b.arm = q.arm""",
        "requests",
    )


@query("invalid_feature_requests", _invalid_sql())
def invalid_feature_requests(spark, sf):
    """E-04: offending (request, feature) rows; a job raises if non-empty."""
    return rs.invalid_requests(_feature_requests(spark, sf))


@query(
    "deterministic_user_sample",
    V("SELECT user_id FROM users ORDER BY sha256(CAST(user_id AS VARCHAR)) LIMIT 20", "users"),
)
def deterministic_user_sample(spark, sf):
    """K-04: the same 20 users on every run, by a hash of their ids."""
    return rs.deterministic_sample(tb.users(spark, sf).select("user_id"), "user_id", 20)


PARITY_DAY = AS_OF - dt.timedelta(days=1)


@query(
    "parity_report",
    V(
        """SELECT feature_name, count(*) AS compared, CAST(0 AS BIGINT) AS differing FROM (
             SELECT s.user_id, f.feature_name FROM users s
             CROSS JOIN (VALUES ('user_ctr_30d'), ('user_impressions_7d'), ('user_rides_per_week'), ('user_account_age_days')) f(feature_name))
           GROUP BY feature_name""",
        "users",
    ),
)
def parity_report(spark, sf):
    """E-06: for every user, the offline values of the one-pass backfill (with
    defaults) against the online resolution of the items that the day's own
    jobs published: two computations of the same features.  Differing cells
    are counted per feature (expected 0)."""
    from adlake.plans.q_quality import user_jobs
    from adlake.sources import publish as pb

    sample = tb.users(spark, sf).select("user_id")
    ub = ft.backfill_user(tb.users(spark, sf), tb.ad_events(spark, sf), tb.rides(spark, sf), PARITY_DAY - dt.timedelta(days=3), AS_OF)
    off = tr.fill_defaults(ub.filter(F.col("asof") == F.lit(PARITY_DAY)), USER_NUM)
    offline = off.select(
        "user_id",
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature_name"), F.col(f).cast("double").alias("value")) for f in USER_NUM])).alias("x"),
    ).select("user_id", "x.feature_name", "x.value")
    # Online: a request per user at noon of the next day.
    root = scratch_path(spark, f"feature-store-{uuid.uuid4().hex}")
    pb.publish_day(spark, root, "user", user_jobs(spark, sf, PARITY_DAY), PARITY_DAY)
    noon = dt.datetime.combine(PARITY_DAY + dt.timedelta(days=1), dt.time(12))
    req = sample.select(F.col("user_id").alias("request_id"), "user_id", F.lit(noon).cast("timestamp").alias("ts"))
    pub = pb.items(spark, root, "user", PARITY_DAY).filter(F.col("feature_name").isin(*USER_NUM)).select(
        F.substring_index("entity_key", "#", -1).cast("long").alias("user_id"), "asof", "feature_name", "value_json", "computed_at"
    )
    empty_rt = spark.createDataFrame([], "request_id long, feature_name string, value_num double, value_text string, age_seconds double")
    on = rs.resolve(req, USER_NUM, empty_rt, pub).select(
        F.col("request_id").alias("user_id"), "feature_name", F.col("value_num").alias("value")
    )
    return rs.parity(offline, on, ["user_id"])
