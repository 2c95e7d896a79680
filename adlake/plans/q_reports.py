"""Named queries: reports over the decision log, serving-side scalar
functions (crosses, labels, Wilson, defaults)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from adlake import config
from adlake.functions import scalar as fx
from adlake.operators import features as ft
from adlake.operators import reports as rp
from adlake.plans.catalog import query
from adlake.plans.q_decisions import DV, GROUP_SCORES, run_decisions
from adlake.plans.q_features import AS_OF
from adlake.plans.sql_views import with_views as V
from adlake.session import scratch_path
from adlake.sources import decision_log as dlog
from adlake.sources import tables as tb

Z = config.Z_95


def _decisions(spark, sf):
    """The decision log the reports read: written by the decision job and
    read back with its fixed schema."""
    path = scratch_path(spark, f"decision-log-{uuid.uuid4().hex}")
    dlog.append(run_decisions(spark, sf)["decisions"], path)
    return dlog.read(spark, path)


_CAP = "CASE WHEN c.demand_type = 'guaranteed' THEN CAST(c.impression_goal AS DOUBLE) ELSE c.budget END"
_REC_CTE = f"""(SELECT *, row_number() OVER (ORDER BY abs(discrepancy) DESC, campaign_id) AS discrepancy_rank FROM (
    SELECT c.campaign_id, c.demand_type, {_CAP} AS initial_capacity,
      {_CAP} - coalesce(d.n, 0) AS remaining_capacity,
      CAST(coalesce(d.n, 0) AS DOUBLE) AS expected_consumed,
      CAST(coalesce(s.n, 0) AS BIGINT) AS actual_served,
      CAST(coalesce(d.n, 0) AS DOUBLE) - coalesce(s.n, 0) AS discrepancy
    FROM campaigns c
    LEFT JOIN (SELECT winner, count(*) AS n FROM dec WHERE winner IS NOT NULL GROUP BY winner) s ON s.winner = c.campaign_id
    LEFT JOIN (SELECT winner, count(*) AS n FROM dec WHERE winner IS NOT NULL AND rung IN ('guaranteed', 'auction')
               GROUP BY winner) d ON d.winner = c.campaign_id
    WHERE c.campaign_id IN (SELECT campaign_id FROM live WHERE day IN (SELECT request_date FROM dec WHERE fallback_rung IS NULL))
       OR d.n IS NOT NULL OR coalesce(s.n, 0) > 0))"""


@query("reconcile_delivery", DV(f"SELECT * FROM {_REC_CTE}"))
def reconcile_delivery(spark, sf):
    """R-01 (+ K-03 rank by |discrepancy|)."""
    return rp.reconcile(_decisions(spark, sf), tb.campaigns(spark, sf))


_LABEL_SQL = "CAST({id} AS VARCHAR) || ' (' || {cat} || ', ' || {adv} || ')'"


@query(
    "spend_delivery_view",
    DV(
        f"""SELECT r.campaign_id, {_LABEL_SQL.format(id='r.campaign_id', cat='c.category', adv='c.advertiser_name')} AS label,
              r.demand_type, round(r.initial_capacity, 1) AS initial, round(r.remaining_capacity, 1) AS remaining,
              round(r.expected_consumed, 1) AS consumed, r.actual_served, round(r.discrepancy, 1) AS discrepancy
            FROM {_REC_CTE} r JOIN campaigns c ON c.campaign_id = r.campaign_id"""
    ),
)
def spend_delivery_view(spark, sf):
    """R-04."""
    c = tb.campaigns(spark, sf)
    return rp.spend_delivery_view(rp.reconcile(_decisions(spark, sf), c), c)


def _wilson_sql(k: str, n: str) -> tuple[str, str]:
    z2 = f"({Z} * {Z})"
    p = f"(CAST({k} AS DOUBLE) / {n})"
    denom = f"(1.0 + {z2} / {n})"
    center = f"({p} + {z2} / (2.0 * {n}))"
    margin = f"({Z} * sqrt({p} * (1.0 - {p}) / {n} + {z2} / (4.0 * {n} * {n})))"
    lo = f"CASE WHEN {n} = 0 THEN 0.0 ELSE ({center} - {margin}) / {denom} END"
    hi = f"CASE WHEN {n} = 0 THEN 0.0 ELSE ({center} + {margin}) / {denom} END"
    return lo, hi


_LO, _HI = _wilson_sql("clicks", "impressions")


@query(
    "experiment_readout",
    DV(
        f"""SELECT *, max(ci_low) OVER () <= min(ci_high) OVER () AS cis_overlap FROM (
            SELECT experiment_arm, impressions, clicks,
              CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0.0 END AS ctr,
              {_LO} AS ci_low, {_HI} AS ci_high
            FROM (SELECT d.experiment_arm, count(*) AS impressions, count(k.request_id) AS clicks
                  FROM dec d LEFT JOIN (
                    SELECT DISTINCT s.request_id FROM
                      (SELECT user_id, campaign_id, ts FROM ad_events WHERE event_type = 'click') c
                      ASOF JOIN (SELECT user_id, winner, ts, request_id FROM dec WHERE winner IS NOT NULL AND winner <> {config.HOUSE_AD_ID}) s
                      ON c.user_id = s.user_id AND c.campaign_id = s.winner AND c.ts >= s.ts) k
                  ON k.request_id = d.request_id
                  WHERE d.winner IS NOT NULL AND d.winner <> {config.HOUSE_AD_ID}
                  GROUP BY d.experiment_arm))"""
    ),
)
def experiment_readout(spark, sf):
    """R-02 with real click labels (J-05 attribution of click events to the
    decisions that served the campaign)."""
    return rp.experiment_readout(_decisions(spark, sf), tb.ad_events(spark, sf, with_category=False))


@query(
    "fallback_rung_counts",
    DV("SELECT fallback_rung, count(*) AS requests FROM dec WHERE fallback_rung IS NOT NULL GROUP BY fallback_rung"),
)
def fallback_rung_counts(spark, sf):
    """A-18."""
    return rp.fallback_rung_counts(_decisions(spark, sf))


_SHARE_SQL = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in config.FIXTURE_STAGE_SHARE.items())
_LAT_SQL = f"""(SELECT event_id AS request_id, ts, stage, value * share AS latency_ms
   FROM events, (VALUES {_SHARE_SQL}) AS shares(stage, share) WHERE event_type = 'view')"""


@query(
    "stage_latency_p99",
    f"""SELECT stage, count(*) AS n, list_sort(list(latency_ms))[CAST(floor(count(*) * 0.99) AS BIGINT) + 1] AS latency_ms_p99,
          avg(latency_ms) AS latency_ms_avg FROM {_LAT_SQL} GROUP BY stage""",
)
def stage_latency_p99(spark, sf):
    """W-06 over all samples of each stage."""
    return rp.stage_latency_p99(tb.request_latencies(spark, sf))


@query(
    "latency_histogram",
    " UNION ALL ".join(
        f"SELECT stage, CAST({b} AS BIGINT) AS bound_ms, count(*) FILTER (WHERE latency_ms <= {b}) AS count FROM {_LAT_SQL} GROUP BY stage"
        for b in config.LATENCY_BUCKETS_MS
    ),
)
def latency_histogram(spark, sf):
    """A-20."""
    return rp.latency_histogram(tb.request_latencies(spark, sf))


@query(
    "counter_rate",
    DV(
        """SELECT poll_ts, requests_total, greatest(0, requests_total - prev) / 3600.0 AS requests_per_sec FROM (
             SELECT poll_ts, requests_total, lag(requests_total) OVER (ORDER BY poll_ts) AS prev FROM (
               SELECT s.poll_ts, CAST(sum(coalesce(c.n, 0)) OVER (ORDER BY s.poll_ts) AS BIGINT) AS requests_total
               FROM (SELECT unnest(generate_series(min(p), max(p), INTERVAL 1 HOUR)) AS poll_ts FROM
                       (SELECT make_timestamp(CAST((floor(epoch(ts) / 3600) + 1) * 3600 * 1000000 AS BIGINT)) AS p FROM dec)) s
               LEFT JOIN (SELECT p, count(*) AS n FROM
                       (SELECT make_timestamp(CAST((floor(epoch(ts) / 3600) + 1) * 3600 * 1000000 AS BIGINT)) AS p FROM dec) GROUP BY p) c
               ON c.p = s.poll_ts)) WHERE prev IS NOT NULL"""
    ),
)
def counter_rate(spark, sf):
    """W-07: rate of the cumulative decision counter between hourly polls."""
    return rp.counter_rate(_decisions(spark, sf))


@query("latest_decision_per_request", DV("SELECT request_id, winner, rung FROM dec"))
def latest_decision_per_request(spark, sf):
    """K-05."""
    return rp.latest_per_request(_decisions(spark, sf))


@query(
    "decisions_enriched",
    DV(
        """SELECT d.request_id, d.user_id, s.segment, d.winner, c.category, c.advertiser_name
           FROM dec d LEFT JOIN user_segments s ON s.user_id = d.user_id LEFT JOIN campaigns c ON c.campaign_id = d.winner"""
    ),
)
def decisions_enriched(spark, sf):
    """J-08."""
    return rp.enriched(_decisions(spark, sf), tb.user_segments(spark, sf), tb.campaigns(spark, sf))


@query(
    "winner_features",
    DV(
        """SELECT d.request_id, d.winner, s.pctr, s.ecpm FROM dec d
           JOIN scored s ON s.request_id = d.request_id AND s.campaign_id = d.winner WHERE d.full_path"""
    ),
)
def winner_features(spark, sf):
    """J-09."""
    return rp.winner_features(_decisions(spark, sf)).select("request_id", "winner", "pctr", "ecpm")


@query(
    "real_impressions",
    DV(f"SELECT request_id, winner FROM dec WHERE winner IS NOT NULL AND winner <> {config.HOUSE_AD_ID}"),
)
def real_impressions(spark, sf):
    """P-09."""
    return rp.real_impressions(_decisions(spark, sf)).select("request_id", "winner")


@query(
    "decision_trail",
    DV(
        f"""SELECT s.request_id, s.campaign_id, s.campaigns,
              {_LABEL_SQL.format(id='s.campaign_id', cat='c.category', adv='c.advertiser_name')} AS label,
              s.pctr, s.ecpm, s.campaign_id = d.winner AS is_winner, d.rung, d.external_bid, e.value AS total_ms
            FROM group_scores s JOIN dec d ON d.request_id = s.request_id AND d.full_path
            JOIN events e ON e.event_id = s.request_id
            JOIN campaigns c ON c.campaign_id = s.campaign_id""",
        extra=GROUP_SCORES,
    ),
)
def decision_trail(spark, sf):
    """R-05."""
    return rp.decision_trail(_decisions(spark, sf), tb.campaigns(spark, sf))


@query(
    "campaign_label",
    DV(
        f"""SELECT d.request_id,
              CASE WHEN d.winner IS NULL THEN '(none)' WHEN c.campaign_id IS NULL THEN CAST(d.winner AS VARCHAR)
                   ELSE {_LABEL_SQL.format(id='d.winner', cat='c.category', adv='c.advertiser_name')} END AS winner_label
            FROM dec d LEFT JOIN campaigns c ON c.campaign_id = d.winner"""
    ),
)
def campaign_label(spark, sf):
    """F-17 on every decision's winner (house ad and none included)."""
    d = _decisions(spark, sf)
    c = tb.campaigns(spark, sf).select(F.col("campaign_id").alias("winner"), "category", "advertiser_name")
    return d.join(c, "winner", "left").select(
        "request_id", fx.campaign_label(F.col("winner"), F.col("advertiser_name"), F.col("category")).alias("winner_label")
    )


_LO2, _HI2 = _wilson_sql("clicks", "impressions")
W30 = f"event_date BETWEEN DATE '{AS_OF - dt.timedelta(days=29)}' AND DATE '{AS_OF}'"


@query(
    "wilson_interval",
    V(
        f"""SELECT campaign_id, impressions, clicks, {_LO2} AS ci_low, {_HI2} AS ci_high FROM (
              SELECT campaign_id, count(*) FILTER (WHERE event_type = 'impression') AS impressions,
                count(*) FILTER (WHERE event_type = 'click') AS clicks
              FROM ad_events WHERE {W30} GROUP BY campaign_id)""",
        "ad_events",
    ),
)
def wilson_interval(spark, sf):
    """F-10 per campaign over 30 days (n = 0 -> (0, 0))."""
    ev = tb.ad_events(spark, sf, with_category=False).filter(fx.in_window("event_date", AS_OF, 30))
    a = ev.groupBy("campaign_id").agg(F.count_if(ft.IMP()).alias("impressions"), F.count_if(ft.CLK()).alias("clicks"))
    lo, hi = fx.wilson_bounds(F.col("clicks"), F.col("impressions"))
    return a.select("campaign_id", "impressions", "clicks", lo.alias("ci_low"), hi.alias("ci_high"))


W7 = f"event_date BETWEEN DATE '{AS_OF - dt.timedelta(days=6)}' AND DATE '{AS_OF}'"


@query(
    "x_user_ctr_in_ad_category",
    V(
        f"""SELECT e.event_id, coalesce(k.ctr, 0.0) AS x_user_ctr_in_ad_category
            FROM ad_events e LEFT JOIN (
              SELECT user_id, category, count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression') AS ctr
              FROM ad_events WHERE {W30} GROUP BY user_id, category HAVING count(*) FILTER (WHERE event_type = 'impression') > 0) k
            ON k.user_id = e.user_id AND k.category = e.category
            WHERE e.event_type = 'impression'""",
        "ad_events",
    ),
)
def x_user_ctr_in_ad_category(spark, sf):
    """F-04: for every impression, the user's 30-day CTR in
    the ad's category from the map feature (0.0 when absent)."""
    ev = tb.ad_events(spark, sf)
    m = ft.ctr_by_category_map(ev, AS_OF, 30)
    imps = ev.filter(ft.IMP()).select("event_id", "user_id", "category")
    return imps.join(m, "user_id", "left").select(
        "event_id",
        fx.map_lookup_default(
            F.coalesce("user_ctr_by_category_30d", F.create_map().cast("map<string,double>")), F.col("category")
        ).alias("x_user_ctr_in_ad_category"),
    )


def audiences_about() -> dict[str, list[str]]:
    """category -> audiences whose rules reference user_ctr_by_category_30d.<category>."""
    out: dict[str, list[str]] = {}
    for a in config.fixture_audiences():
        for f, _, _ in a.rules:
            if f.startswith("user_ctr_by_category_30d."):
                out.setdefault(f.split(".", 1)[1], []).append(a.name)
    return out


def _about_sql() -> str:
    parts = [
        f"WHEN e.category = '{c}' THEN list_has_any(coalesce(m.audience_memberships, CAST([] AS VARCHAR[])), [{', '.join(repr(n) for n in ns)}])"
        for c, ns in audiences_about().items()
    ]
    return "CASE " + " ".join(parts) + " ELSE false END"


@query(
    "x_user_in_audience_matching",
    V(
        f"""SELECT e.event_id, {_about_sql()} AS x_user_in_audience_matching_ad_category
            FROM ad_events e LEFT JOIN mem m ON m.user_id = e.user_id
            WHERE e.event_type = 'impression'""",
        "ad_events",
        "rides",
        "user_segments",
        extra=__import__("adlake.plans.q_quality", fromlist=["membership_ctes"]).membership_ctes(AS_OF, 1)
        + [("mem", "SELECT user_id, list(audience ORDER BY audience_order) AS audience_memberships FROM mem_long GROUP BY user_id")],
    ),
)
def x_user_in_audience_matching(spark, sf):
    """F-05: for every impression, whether the user belongs
    to an audience whose own rules reference the ad's category."""
    ev = tb.ad_events(spark, sf)
    long = ft.memberships_backfill(tb.user_segments(spark, sf), ev, tb.rides(spark, sf), AS_OF, AS_OF, config.fixture_audiences())
    mem = ft.membership_lists(long).select("user_id", "audience_memberships")
    about = audiences_about()
    amap = F.create_map(*[x for c, ns in about.items() for x in (F.lit(c), F.array(*[F.lit(n) for n in ns]))])
    imps = ev.filter(ft.IMP()).select("event_id", "user_id", "category")
    j = imps.join(mem, "user_id", "left")
    flag = F.coalesce(
        F.arrays_overlap(
            F.coalesce("audience_memberships", F.array().cast("array<string>")),
            F.try_element_at(amap, F.col("category")),
        ),
        F.lit(False),
    )
    return j.select("event_id", flag.alias("x_user_in_audience_matching_ad_category"))


def registry_defaults() -> dict[str, object]:
    return {n: d for n, _, _, _, _, d in config.REGISTRY}


@query(
    "fill_defaults",
    V(
        f"""SELECT u.user_id, coalesce(a.ctr, 0.0) AS user_ctr_30d, coalesce(b.n, 0) AS user_impressions_7d,
              coalesce(r.user_rides_per_week, 0.0) AS user_rides_per_week,
              coalesce(CAST(DATE '{AS_OF}' - u.created_at AS BIGINT), 0) AS user_account_age_days
            FROM users u
            LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression') AS ctr
                       FROM ad_events WHERE {W30} GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'impression') > 0) a
              ON a.user_id = u.user_id
            LEFT JOIN (SELECT user_id, count(*) AS n FROM ad_events WHERE {W7} AND event_type = 'impression' GROUP BY user_id) b
              ON b.user_id = u.user_id
            LEFT JOIN (SELECT user_id, CAST(count(*) AS DOUBLE) AS user_rides_per_week FROM rides
                       WHERE ride_date BETWEEN DATE '{AS_OF - dt.timedelta(days=6)}' AND DATE '{AS_OF}' GROUP BY user_id) r
              ON r.user_id = u.user_id""",
        "users",
        "ad_events",
        "rides",
    ),
)
def fill_defaults(spark, sf):
    """F-14: registry defaults substituted for missing values of the user
    snapshot (a real "no data" null becomes the declared default)."""
    ev = tb.ad_events(spark, sf, with_category=False)
    frames = [
        ft.account_age(tb.users(spark, sf), AS_OF),
        ft.ctr_overall(ev, AS_OF, 30, "user_id", "user_ctr_30d"),
        ft.impressions_count(ev, AS_OF, 7, "user_id", "user_impressions_7d"),
        ft.rides_count(tb.rides(spark, sf), AS_OF, 7),
    ]
    merged = ft.merge_entity_frames(frames, "user_id")
    return fill_registry_defaults(merged, ["user_ctr_30d", "user_impressions_7d", "user_rides_per_week", "user_account_age_days"])


def fill_registry_defaults(df, names: list[str]):
    d = registry_defaults()
    return df.select(
        *[F.coalesce(F.col(c), F.lit(d[c])).alias(c) if c in names else F.col(c) for c in df.columns]
    )
