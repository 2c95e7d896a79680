"""Named queries: decisions (D-*), ranking (K-*), range / rule joins, scalar
functions of the serving path, and the reports over the decision log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake import config
from adlake.functions import scalar as fx
from adlake.operators import decisions as dc
from adlake.operators import features as ft
from adlake.plans.catalog import query
from adlake.plans.q_features import AS_OF
from adlake.plans.q_quality import membership_ctes
from adlake.plans.sql_views import with_views as V
from adlake.session import materialize, scratch_path
from adlake.sources import decision_log as dlog
from adlake.sources import tables as tb

START = config.FIXTURE_START
END = AS_OF
N_DAYS = (END - START).days + 1

# ------------------------------------------------------------ spark inputs


def request_days(spark, sf) -> tuple[dt.date, dt.date]:
    """First and last day that has requests."""
    first, last = tb.requests(spark, sf).agg(F.min("request_date"), F.max("request_date")).first()
    return first or START, last or END


def fixture_inputs(spark, sf, availability: bool = True, **more) -> dc.DecisionInputs:
    ev = tb.ad_events(spark, sf)
    camps = tb.campaigns(spark, sf)
    segs = tb.user_segments(spark, sf)
    auds = config.fixture_audiences()
    sess = tb.session_events(spark, sf)
    dests = sess.filter(F.col("event_type") == "destination_entered").select(
        "user_id", "ts", F.col("payload")["category"].alias("category")
    )
    ad_ctr = ft.ctr_overall(tb.ad_events(spark, sf, with_category=False), AS_OF, 30, "campaign_id", "ad_ctr_30d")
    # Bid and dependency health are columns of the request event itself.
    reqs = tb.requests_enriched(spark, sf)
    first, last = request_days(spark, sf)
    return dc.DecisionInputs(
        requests=reqs if availability else reqs.drop("model_ok", "features_ok", "pacing_ok"),
        campaigns=camps,
        segments=segs,
        memberships=None,
        user_context=ft.membership_context(
            segs, ev, tb.rides(spark, sf), first - dt.timedelta(days=1), last - dt.timedelta(days=1), auds,
            spine=reqs.select("user_id", F.date_sub("request_date", 1).alias("asof")).distinct(),
        ),
        destinations=dests,
        ledger=dc.ledger_from_impressions(ev, camps),
        bids=None,
        availability=None,
        popularity=dc.popularity_ranking(camps, ad_ctr),
        lift_rules=config.lift_rules_df(spark),
        audiences=auds,
        **more,
    )


def run_decisions(spark, sf, **more) -> dict[str, DataFrame]:
    """The decision job on the fixture inputs; its decisions are written once."""
    out = dc.decide(fixture_inputs(spark, sf, **more), *request_days(spark, sf))
    out["decisions"] = materialize(out["decisions"])
    return out


# ------------------------------------------------------------ SQL oracle

_AUD_VERSION_SQL = "CASE " + " ".join(
    f"WHEN audience = '{a.name}' THEN CAST({a.version} AS BIGINT)" for a in config.fixture_audiences()
) + " ELSE CAST(-1 AS BIGINT) END"

_ARM_SQL = """CASE WHEN (('0x' || right(sha256('phase5-ab-v1:' || CAST(user_id AS VARCHAR)), 1))::INTEGER) % 2 = 0
   THEN 'control' ELSE 'treatment' END"""

_DEC_CTES: list[tuple[str, str]] = membership_ctes(START - dt.timedelta(days=1), N_DAYS) + [
    (
        "mem",
        "SELECT user_id, as_of_date, list(audience ORDER BY audience_order) AS audience_memberships FROM mem_long GROUP BY user_id, as_of_date",
    ),
    (
        "ledger",
        """SELECT e.campaign_id, e.event_date AS day, count(*) AS wins,
             CASE WHEN c.demand_type = 'guaranteed' THEN count(*) ELSE 0 END AS guaranteed_wins
           FROM ad_events e JOIN campaigns c ON e.campaign_id = c.campaign_id
           WHERE e.event_type = 'impression' GROUP BY e.campaign_id, e.event_date, c.demand_type""",
    ),
    (
        "live",
        f"""SELECT c.*, CAST(greatest(c.flight_start, DATE '{START}') + CAST(t.i AS INTEGER) AS DATE) AS day
           FROM campaigns c JOIN range(0, 400) t(i)
             ON greatest(c.flight_start, DATE '{START}') + CAST(t.i AS INTEGER) <= least(c.flight_end, DATE '{END}')
           WHERE c.status = 'active'""",
    ),
    (
        "capday",
        """SELECT l.*,
             CASE WHEN l.demand_type = 'guaranteed' THEN CAST(l.impression_goal AS DOUBLE) ELSE l.budget END AS initial_capacity,
             coalesce((SELECT sum(g.wins) FROM ledger g WHERE g.campaign_id = l.campaign_id AND g.day < l.day), 0) AS wins_before,
             coalesce((SELECT sum(g.guaranteed_wins) FROM ledger g WHERE g.campaign_id = l.campaign_id AND g.day < l.day), 0) AS delivered_before
           FROM live l""",
    ),
    (
        "catday",
        """SELECT *, initial_capacity - wins_before AS remaining_capacity,
             CASE WHEN flight_end - flight_start <= 0 THEN 1.0
                  ELSE greatest(0.0, least(1.0, (day - flight_start) / (flight_end - flight_start))) END AS frac
           FROM capday""",
    ),
    (
        "catday2",
        """SELECT *, demand_type = 'guaranteed' AND CAST(delivered_before AS DOUBLE) < CAST(impression_goal AS DOUBLE) * frac AS behind,
             CASE WHEN impression_goal * frac > 0 THEN delivered_before / (impression_goal * frac) ELSE 0.0 END AS urgency,
             CAST(greatest(0, least(ceil(impression_goal * frac - delivered_before), floor(remaining_capacity))) AS BIGINT) AS quota
           FROM catday""",
    ),
    (
        "dests",
        "SELECT user_id, ts, category FROM session_events WHERE event_type = 'destination_entered'",
    ),
    (
        "rdest",
        f"""SELECT r.request_id,
             CASE WHEN epoch_us(r.ts) - epoch_us(d.ts) < {config.SESSION_TTL_SECONDS} * 1000000 THEN d.category END AS destination
           FROM requests r ASOF LEFT JOIN dests d ON r.user_id = d.user_id AND r.ts >= d.ts""",
    ),
    (
        "avail",
        """SELECT event_id AS request_id, NOT (value >= 2 AND value < 3) AS model_ok, NOT (value < 1) AS features_ok,
             NOT (value >= 1 AND value < 2) AS pacing_ok FROM events WHERE event_type = 'view'""",
    ),
    (
        "req",
        f"""SELECT r.request_id, r.user_id, r.ts, r.request_date, r.hour_of_day,
             {_ARM_SQL.replace('user_id', 'r.user_id')} AS experiment_arm,
             CASE WHEN {_ARM_SQL.replace('user_id', 'r.user_id')} = 'control' THEN 'v1' ELSE 'v2' END AS model_version,
             m.audience_memberships, s.segment, rd.destination, b.bid AS external_bid,
             a.model_ok, a.features_ok, a.pacing_ok
           FROM requests r
           LEFT JOIN mem m ON m.user_id = r.user_id AND m.as_of_date = r.request_date - 1
           LEFT JOIN user_segments s ON s.user_id = r.user_id
           LEFT JOIN rdest rd ON rd.request_id = r.request_id
           LEFT JOIN external_bids b ON b.request_id = r.request_id
           LEFT JOIN avail a ON a.request_id = r.request_id""",
    ),
    (
        "cands",
        """SELECT q.*, c.campaign_id, c.category, c.demand_type, c.bid, c.remaining_capacity, c.behind, c.urgency, c.quota,
             c.targeted_audiences,
             c.remaining_capacity > 0 AS has_capacity,
             (len(c.targeted_audiences) = 0 OR list_has_any(c.targeted_audiences, coalesce(q.audience_memberships, CAST([] AS VARCHAR[])))) AS audience_ok
           FROM req q JOIN catday2 c ON q.request_date = c.day""",
    ),
    ("elig", "SELECT * FROM cands WHERE has_capacity AND audience_ok"),
    (
        "excl",
        f"""SELECT request_id, campaign_id, audience, {_AUD_VERSION_SQL} AS definition_version
           FROM (SELECT request_id, campaign_id, unnest(targeted_audiences) AS audience FROM cands
                 WHERE has_capacity AND NOT audience_ok)""",
    ),
    ("lift_rules", config.lift_rules_sql()),
    (
        "lift",
        """SELECT segment, category, day_part, multiplier AS lift FROM (
             SELECT r.segment, c.category, p.day_part, r.multiplier,
               row_number() OVER (PARTITION BY r.segment, c.category, p.day_part
                 ORDER BY (r.category <> '*') DESC, (r.cond <> 'any') DESC, r.rule_order DESC) AS rn
             FROM (SELECT DISTINCT category FROM campaigns) c
             JOIN lift_rules r ON r.category = c.category OR r.category = '*'
             JOIN (VALUES ('day'), ('night')) p(day_part) ON r.cond = 'any' OR r.cond = p.day_part) WHERE rn = 1""",
    ),
    (
        "scored0",
        """SELECT e.*, least(CAST(0.03 AS DOUBLE) * coalesce(l.lift, 1.0), CAST(0.6 AS DOUBLE)) AS base_pctr
           FROM (SELECT *, CASE WHEN hour_of_day IN (20, 21, 22, 23, 0, 1, 2, 3, 4) THEN 'night' ELSE 'day' END AS day_part
                 FROM elig WHERE demand_type = 'auction') e
           LEFT JOIN lift l ON l.segment = e.segment AND l.category = e.category AND l.day_part = e.day_part""",
    ),
    (
        "scored",
        """SELECT *, CASE WHEN bid IS NOT NULL THEN bid * pctr END AS ecpm FROM (
             SELECT *, CASE WHEN destination IS NOT NULL AND destination <> '' AND destination = category
                            THEN least(CAST(1.0 AS DOUBLE), base_pctr * CAST(1.5 AS DOUBLE)) ELSE base_pctr END AS pctr
             FROM scored0)""",
    ),
    (
        "gbest",
        """SELECT request_id, g_winner FROM (
             SELECT request_id, g_winner, quota,
               row_number() OVER (PARTITION BY g_winner, request_date ORDER BY ts, request_id) AS qr
             FROM (SELECT request_id, request_date, ts, campaign_id AS g_winner, quota FROM (
                     SELECT request_id, request_date, ts, campaign_id, quota,
                       row_number() OVER (PARTITION BY request_id ORDER BY urgency, campaign_id) AS rn
                     FROM elig WHERE behind AND model_ok AND features_ok AND pacing_ok) WHERE rn = 1))
           WHERE qr <= quota""",
    ),
    (
        "abest",
        """SELECT request_id, campaign_id AS a_winner, ecpm AS a_ecpm FROM (
             SELECT request_id, campaign_id, ecpm,
               row_number() OVER (PARTITION BY request_id ORDER BY coalesce(ecpm, 0.0) DESC, campaign_id) AS rn
             FROM scored) WHERE rn = 1""",
    ),
    (
        "arb",
        """SELECT q.request_id,
             CASE WHEN g.g_winner IS NOT NULL THEN g.g_winner
                  WHEN q.external_bid IS NOT NULL AND q.external_bid > coalesce(a.a_ecpm, 0.0) THEN NULL
                  ELSE a.a_winner END AS winner,
             CASE WHEN g.g_winner IS NOT NULL THEN 'guaranteed'
                  WHEN q.external_bid IS NOT NULL AND q.external_bid > coalesce(a.a_ecpm, 0.0) THEN 'external'
                  WHEN a.a_winner IS NOT NULL THEN 'auction' ELSE 'none' END AS rung,
             CASE WHEN g.g_winner IS NOT NULL THEN NULL
                  WHEN q.external_bid IS NOT NULL AND q.external_bid > coalesce(a.a_ecpm, 0.0) THEN q.external_bid
                  WHEN a.a_winner IS NOT NULL THEN a.a_ecpm END AS price
           FROM req q LEFT JOIN gbest g ON g.request_id = q.request_id LEFT JOIN abest a ON a.request_id = q.request_id
           WHERE q.model_ok AND q.features_ok AND q.pacing_ok""",
    ),
    (
        "adctr",
        f"""SELECT campaign_id, count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression') AS ad_ctr_30d
           FROM ad_events WHERE event_date BETWEEN DATE '{AS_OF - dt.timedelta(days=29)}' AND DATE '{AS_OF}'
           GROUP BY campaign_id HAVING count(*) FILTER (WHERE event_type = 'impression') > 0""",
    ),
    (
        "popularity",
        """SELECT c.campaign_id, row_number() OVER (ORDER BY coalesce(a.ad_ctr_30d, 0.0) DESC, c.campaign_id) AS popularity_rank
           FROM campaigns c LEFT JOIN adctr a ON a.campaign_id = c.campaign_id""",
    ),
    (
        "fallback",
        """SELECT day, arg_min(l.campaign_id, p.popularity_rank) AS fallback_campaign_id
           FROM live l JOIN popularity p ON p.campaign_id = l.campaign_id
           WHERE len(l.targeted_audiences) = 0 GROUP BY day""",
    ),
    (
        "dec",
        f"""SELECT q.request_id, q.user_id, q.ts, q.request_date, q.experiment_arm, q.model_version,
             CASE WHEN NOT q.model_ok THEN '{dc.RUNG_MODEL_DOWN}' WHEN NOT q.features_ok THEN '{dc.RUNG_FEATURES_DOWN}'
                  WHEN NOT q.pacing_ok THEN '{dc.RUNG_PACING_DOWN}' END AS fallback_rung,
             CASE WHEN NOT q.model_ok THEN CAST({config.HOUSE_AD_ID} AS BIGINT)
                  WHEN NOT (q.features_ok AND q.pacing_ok) THEN f.fallback_campaign_id ELSE a.winner END AS winner,
             CASE WHEN NOT q.model_ok THEN '{dc.RUNG_MODEL_DOWN}' WHEN NOT q.features_ok THEN '{dc.RUNG_FEATURES_DOWN}'
                  WHEN NOT q.pacing_ok THEN '{dc.RUNG_PACING_DOWN}' ELSE a.rung END AS rung,
             a.price,
             CASE WHEN NOT (q.model_ok AND q.features_ok AND q.pacing_ok) THEN NULL
                  WHEN q.external_bid IS NOT NULL THEN 'bid' ELSE 'no_bid' END AS external_bid_outcome,
             CASE WHEN q.model_ok AND q.features_ok AND q.pacing_ok THEN q.external_bid END AS external_bid,
             q.model_ok AND q.features_ok AND q.pacing_ok AS full_path
           FROM req q LEFT JOIN arb a ON a.request_id = q.request_id LEFT JOIN fallback f ON f.day = q.request_date""",
    ),
]
#: The best campaign of each (request, targeted audiences, category), and how many there are.
GROUP_SCORES: list[tuple[str, str]] = [
    (
        "group_scores",
        """SELECT request_id, audiences, category, campaign_id, pctr, ecpm, campaigns FROM (
             SELECT request_id, audiences, category, campaign_id, pctr, ecpm,
               count(*) OVER (PARTITION BY request_id, audiences, category) AS campaigns,
               row_number() OVER (PARTITION BY request_id, audiences, category ORDER BY coalesce(ecpm, 0.0) DESC, campaign_id) AS rn
             FROM (SELECT *, array_to_string(list_sort(targeted_audiences), ',') AS audiences FROM scored)) WHERE rn = 1""",
    ),
]
_DEC_VIEWS = ("campaigns", "ad_events", "rides", "user_segments", "session_events", "requests", "external_bids")


def DV(body: str, upto: str | None = None, extra: list[tuple[str, str]] | None = None) -> str:
    """Oracle SQL over the decision CTE chain (optionally cut after `upto`,
    optionally followed by more CTEs)."""
    ctes = _DEC_CTES
    if upto is not None:
        names = [n for n, _ in ctes]
        ctes = ctes[: names.index(upto) + 1]
    return V(body, *_DEC_VIEWS, "users", extra=ctes + (extra or []))


# ------------------------------------------------------------ keys


@query(
    "requests_x_live_campaigns",
    DV("SELECT q.request_id, l.campaign_id FROM requests q JOIN live l ON q.request_date = l.day", "live"),
)
def requests_x_live_campaigns(spark, sf):
    """J-04 / J-10: every request with every campaign live on its day.  The
    flight range join is an equi-join on the exploded (campaign, day)."""
    live = dc.live_days(tb.campaigns(spark, sf), *request_days(spark, sf)).select("campaign_id", "day")
    return dc.pairs_of_day(tb.requests(spark, sf), live).select("request_id", "campaign_id")


@query(
    "catalog_only_eligible",
    DV("SELECT day, campaign_id FROM live WHERE len(targeted_audiences) = 0", "live"),
)
def catalog_only_eligible(spark, sf):
    """P-08 per day."""
    return dc.catalog_only_days(tb.campaigns(spark, sf), *request_days(spark, sf))


@query("popularity_ranking", DV("SELECT campaign_id, popularity_rank FROM popularity", "popularity"))
def popularity_ranking(spark, sf):
    """K-01."""
    ad_ctr = ft.ctr_overall(tb.ad_events(spark, sf, with_category=False), AS_OF, 30, "campaign_id", "ad_ctr_30d")
    return dc.popularity_ranking(tb.campaigns(spark, sf), ad_ctr)


@query("popularity_fallback", DV("SELECT day, fallback_campaign_id FROM fallback", "fallback"))
def popularity_fallback(spark, sf):
    """K-02 per day."""
    ad_ctr = ft.ctr_overall(tb.ad_events(spark, sf, with_category=False), AS_OF, 30, "campaign_id", "ad_ctr_30d")
    c = tb.campaigns(spark, sf)
    return dc.popularity_fallback(c, dc.popularity_ranking(c, ad_ctr), *request_days(spark, sf))


_EV_LIFT_SQL = """SELECT e.event_id, coalesce(l.lift, 1.0) AS lift
   FROM (SELECT a.event_id, a.category, s.segment,
           CASE WHEN a.hour_of_day IN (20, 21, 22, 23, 0, 1, 2, 3, 4) THEN 'night' ELSE 'day' END AS day_part
         FROM ad_events a LEFT JOIN user_segments s ON s.user_id = a.user_id WHERE a.event_type = 'impression') e
   LEFT JOIN lift l ON l.segment = e.segment AND l.category = e.category AND l.day_part = e.day_part"""


def _event_lift(spark, sf):
    ev = tb.ad_events(spark, sf).filter(F.col("event_type") == "impression")
    ev = ev.join(tb.user_segments(spark, sf), "user_id", "left").withColumn("day_part", fx.day_part(F.col("hour_of_day")))
    lift = dc.lift_lookup(config.lift_rules_df(spark), tb.campaigns(spark, sf))
    return ev.join(lift, ["segment", "category", "day_part"], "left").select(
        "event_id", F.coalesce("lift", F.lit(1.0)).alias("lift")
    )


@query("rule_table_lookup", DV(_EV_LIFT_SQL, "lift"))
def rule_table_lookup(spark, sf):
    """J-11: lift multiplier of every impression's (segment, category, day
    part); most specific rule, later rule on ties, default 1.0."""
    return _event_lift(spark, sf)


@query(
    "expected_ctr",
    DV(f"SELECT event_id, least(CAST(0.03 AS DOUBLE) * lift, CAST(0.6 AS DOUBLE)) AS expected_ctr FROM ({_EV_LIFT_SQL})", "lift"),
)
def expected_ctr(spark, sf):
    """F-12: click probability = min(0.03 x lift, 0.6)."""
    return _event_lift(spark, sf).select("event_id", fx.click_probability(F.col("lift")).alias("expected_ctr"))


@query("eligible_candidates", DV("SELECT request_id, campaign_id FROM elig", "elig"))
def eligible_candidates(spark, sf):
    """D-01: every request with every campaign that is eligible for it."""
    return run_decisions(spark, sf)["eligible"].select("request_id", "campaign_id")


@query("audience_exclusions", DV("SELECT request_id, campaign_id, audience, definition_version FROM excl", "excl"))
def audience_exclusions(spark, sf):
    """D-02."""
    return run_decisions(spark, sf)["exclusions"]


@query("candidate_ecpm", DV("SELECT request_id, campaign_id, pctr, ecpm FROM scored", "scored"))
def candidate_ecpm(spark, sf):
    """D-04 with the stand-in score column (expected CTR from the rule table,
    destination boost, bid x pctr) of every request and eligible auction campaign."""
    return run_decisions(spark, sf)["scored_pairs"]


@query("arbitrate_requests", DV("SELECT request_id, winner, rung, price FROM arb", "arb"))
def arbitrate_requests(spark, sf):
    """D-05 over the requests that reach arbitration."""
    return run_decisions(spark, sf)["arbitrated"].select("request_id", "winner", "rung", "price")


@query(
    "decide_with_fallback",
    DV("SELECT request_id, experiment_arm, model_version, winner, rung, fallback_rung, price, external_bid_outcome FROM dec"),
)
def decide_with_fallback(spark, sf):
    """D-07: the full job including the fallback ladder."""
    d = run_decisions(spark, sf)["decisions"]
    return d.select("request_id", "experiment_arm", "model_version", "winner", "rung", "fallback_rung", "price",
                    "external_bid_outcome")


_REC_SQL = DV(
    """SELECT d.request_id, d.winner, d.rung, d.external_bid_outcome,
         CASE WHEN d.full_path THEN coalesce(e.n, 0) END AS n_candidates,
         CASE WHEN d.full_path THEN coalesce(e.id_sum, 0) END AS candidate_id_sum,
         CASE WHEN d.full_path THEN coalesce(x.n, 0) END AS n_exclusions,
         CASE WHEN d.full_path THEN coalesce(s.n, 0) END AS n_scores,
         CASE WHEN d.full_path THEN d.request_date - 1 END AS features_as_of,
         CASE WHEN d.full_path THEN CAST(floor(epoch(d.ts)) - epoch(d.request_date) AS BIGINT) END AS feature_age_seconds,
         v.value AS total_ms, v.value * 0.25 AS features_ms
       FROM dec d
       JOIN events v ON v.event_id = d.request_id
       LEFT JOIN (SELECT request_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(campaign_id) AS BIGINT) AS id_sum
                  FROM elig GROUP BY request_id) e ON e.request_id = d.request_id
       LEFT JOIN (SELECT request_id, CAST(count(*) AS BIGINT) AS n FROM excl GROUP BY request_id) x ON x.request_id = d.request_id
       LEFT JOIN (SELECT request_id, CAST(count(*) AS BIGINT) AS n FROM scored GROUP BY request_id) s ON s.request_id = d.request_id"""
)


@query("decision_records", _REC_SQL)
def decision_records(spark, sf):
    """D-09: the nested decision record, checked on its scalar projection
    (counts and id sums of candidates, exclusions and scores, freshness of the
    features, stage latencies)."""
    return _record_scalars(run_decisions(spark, sf)["decisions"])


def _record_scalars(d):
    total = lambda c, f: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x[f])
    return d.select(
        "request_id", "winner", "rung", "external_bid_outcome",
        total("candidate_set", "campaigns").alias("n_candidates"),
        total("candidate_set", "id_sum").alias("candidate_id_sum"),
        total("audience_exclusions", "campaigns").alias("n_exclusions"),
        total("scores", "campaigns").alias("n_scores"),
        "features_as_of", "feature_age_seconds",
        F.col("stage_latencies_ms")["total"].alias("total_ms"), F.col("stage_latencies_ms")["features"].alias("features_ms"),
    )


def _write_log(spark, sf) -> str:
    path = scratch_path(spark, f"decision-log-{uuid.uuid4().hex}")
    dlog.append(run_decisions(spark, sf)["decisions"], path)
    return path


@query("decision_log_write", _REC_SQL)
def decision_log_write(spark, sf):
    """S-04: append the decisions to a date-partitioned Parquet log and read
    the written partitions back."""
    path = _write_log(spark, sf)
    return _record_scalars(dlog.read(spark, path))


@query("decision_log_read", DV("SELECT request_id, winner, rung FROM dec"))
def decision_log_read(spark, sf):
    """S-05: read with the fixed schema (a missing log reads as empty)."""
    path = _write_log(spark, sf)
    missing = dlog.read(spark, path + "-missing")
    return dlog.read(spark, path).unionByName(missing).select("request_id", "winner", "rung")


_CAMP_CAP_SQL = """CASE WHEN c.demand_type = 'guaranteed' THEN CAST(c.impression_goal AS DOUBLE) ELSE c.budget END"""


@query(
    "remaining_capacity",
    DV(
        f"""SELECT c.campaign_id, c.demand_type, {_CAMP_CAP_SQL} AS initial_capacity, w.n AS decremented_wins,
              {_CAMP_CAP_SQL} - w.n AS remaining_capacity
            FROM campaigns c JOIN (SELECT winner, count(*) AS n FROM dec WHERE winner IS NOT NULL AND rung IN ('guaranteed', 'auction')
                                   GROUP BY winner) w ON w.winner = c.campaign_id"""
    ),
)
def remaining_capacity(spark, sf):
    """D-03 after the decision log: initial - decremented wins."""
    d = run_decisions(spark, sf)["decisions"]
    return dc.remaining_capacity(d, tb.campaigns(spark, sf))


@query(
    "pacing_status",
    DV(
        f"""SELECT c.campaign_id, c.impression_goal, CAST(coalesce(w.n, 0) AS BIGINT) AS delivered, f.frac AS flight_fraction,
              c.impression_goal * f.frac AS expected_by_now,
              CAST(coalesce(w.n, 0) AS DOUBLE) < CAST(c.impression_goal AS DOUBLE) * f.frac AS behind_schedule
            FROM campaigns c
            JOIN (SELECT campaign_id, CASE WHEN flight_end - flight_start <= 0 THEN 1.0
                    ELSE greatest(0.0, least(1.0, (DATE '{AS_OF}' - flight_start) / (flight_end - flight_start))) END AS frac
                  FROM campaigns) f ON f.campaign_id = c.campaign_id
            LEFT JOIN (SELECT winner, count(*) AS n FROM dec WHERE rung = 'guaranteed' GROUP BY winner) w ON w.winner = c.campaign_id
            WHERE c.demand_type = 'guaranteed'"""
    ),
)
def pacing_status(spark, sf):
    """D-06."""
    d = run_decisions(spark, sf)["decisions"]
    return dc.pacing_status(d, tb.campaigns(spark, sf), AS_OF)


@query(
    "flight_fraction",
    V(
        f"""SELECT campaign_id, CASE WHEN flight_end - flight_start <= 0 THEN 1.0
              ELSE greatest(0.0, least(1.0, (DATE '{AS_OF}' - flight_start) / (flight_end - flight_start))) END AS flight_fraction
            FROM campaigns""",
        "campaigns",
    ),
)
def flight_fraction(spark, sf):
    """F-07."""
    c = tb.campaigns(spark, sf)
    return c.select("campaign_id", fx.flight_fraction(fx.lit_date(AS_OF), F.col("flight_start"), F.col("flight_end")).alias("flight_fraction"))


@query("assign_arm", V(f"SELECT user_id, {_ARM_SQL} AS experiment_arm FROM users", "users"))
def assign_arm(spark, sf):
    """F-06."""
    return tb.user_segments(spark, sf).select("user_id", fx.assign_arm(F.col("user_id")).alias("experiment_arm"))


@query("pacing_replay")
def pacing_replay(spark, sf):
    """D-08: the decision job day after day on its own log; per guaranteed
    campaign the goal and what was delivered."""
    inp = fixture_inputs(spark, sf)
    # The log is the only ledger: start with no deliveries.
    inp.ledger = inp.ledger.limit(0)
    dec = dc.decide_in_days(inp, *request_days(spark, sf), scratch_path(spark, f"pacing-{uuid.uuid4().hex}"))
    g = tb.campaigns(spark, sf).filter(F.col("demand_type") == "guaranteed")
    delivered = dec.filter(F.col("rung") == "guaranteed").groupBy(F.col("winner").alias("campaign_id")).agg(
        F.count("*").alias("delivered")
    )
    return g.join(delivered, "campaign_id", "left").select(
        "campaign_id", "impression_goal", F.coalesce("delivered", F.lit(0)).cast("long").alias("delivered"),
        "flight_start", "flight_end", "status",
    )
