"""Ad decisions as set-based jobs over a table (or micro-batch) of requests
(D-01 .. D-09, K-01, K-02, J-04, J-10, J-11).

Plan shape: a request never meets campaigns one by one.  What a request can
get from the catalog depends only on its day, its audiences and the category
of the campaign, so the live catalog is first reduced to *candidate groups*:
one row per (day, targeted audiences, category) with the number of campaigns,
the best auction bid and the most urgent guaranteed campaign.  A context index
holds the groups of a day with the click probability of each (segment, day
part).  A request picks up one index row (an equi-join) and filters, scores
and arbitrates its groups inside that row.  The size of every step is requests
plus catalog, never their product; :func:`eligible_pairs` and
:func:`scored_pairs` expand the pairs for whoever wants them.

Counters: a set-based job sees capacity and delivery as of the start of
the request's day, taken from a delivery ledger (campaign, day, wins,
guaranteed_wins).  :func:`decide_in_days` feeds each day's own wins to the next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import (
    assign_arm,
    behind_schedule,
    boosted_pctr,
    click_probability,
    day_part,
    ecpm,
    flight_fraction,
    lit_date,
)
from adlake.operators.asof import latest_within
from adlake.operators.ranks import row_numbers
from adlake.session import materialize

RUNG_MODEL_DOWN = "model_load_failure_house_ad"
RUNG_FEATURES_DOWN = "feature_service_down_popularity_fallback"
RUNG_PACING_DOWN = "redis_down_popularity_fallback"


@dataclass
class DecisionInputs:
    requests: DataFrame  # request_id, user_id, ts, request_date, hour_of_day
    campaigns: DataFrame  # the whole catalog
    segments: DataFrame  # user_id, segment
    memberships: DataFrame  # user_id, asof, audience_memberships (as of asof)
    destinations: DataFrame  # user_id, ts, category  (destination_entered events)
    ledger: DataFrame  # campaign_id, day, wins, guaranteed_wins (deliveries before requests)
    bids: DataFrame | None = None  # request_id, bid
    availability: DataFrame | None = None  # request_id, model_ok, features_ok, pacing_ok
    popularity: DataFrame | None = None  # campaign_id, popularity_rank
    lift_rules: DataFrame | None = None  # rule_order, segment, category, cond, multiplier
    audiences: list[config.Audience] | None = None
    ad_features: DataFrame | None = None  # campaign_id, day, numbers that the scorer uses
    scorer: Callable[[DataFrame], DataFrame] | None = None  # rows of a request and a group -> the same with pctr
    user_context: DataFrame | None = None  # user_id, asof, segment, audience_memberships (one join)
    granted: DataFrame | None = None  # campaign_id, day, granted (guaranteed wins of earlier batches)


# ------------------------------------------------------------- catalog side


def live_days(campaigns: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """J-04: (campaign, day) for every day of an ACTIVE campaign's flight in
    [start, end].  Size = catalog x flight length."""
    s, e = lit_date(start), lit_date(end)
    lo = F.greatest(F.col("flight_start"), s)
    hi = F.least(F.col("flight_end"), e)
    return (
        campaigns.filter((F.col("status") == "active") & (lo <= hi))
        .withColumn("day", F.explode(F.sequence(lo, hi)))
    )


def capacity_at_day_start(campaigns: DataFrame, ledger: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """D-03 / D-06 as of each day start: initial capacity (goal or budget)
    minus all ledger wins before the day; guaranteed deliveries before it.
    Windows run per campaign over at most one row per day."""
    days = live_days(campaigns, start, end).select("campaign_id", "day", "demand_type", "impression_goal", "budget")
    daily = (
        ledger.filter(F.col("day") <= lit_date(end))
        .groupBy("campaign_id", "day")
        .agg(F.sum("wins").alias("wins"), F.sum("guaranteed_wins").alias("gwins"))
    )
    # Running ledger totals read at each live day: a marker row per live
    # day sorts before that day's ledger row, so the running sum at the
    # marker counts wins strictly before the day.  <= 2 rows per day.
    markers = days.select("campaign_id", "day", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("wins"),
                          F.lit(0).cast("long").alias("gwins"))
    u = markers.unionByName(daily.select("campaign_id", "day", F.lit(1).alias("kind"),
                                         F.col("wins").cast("long"), F.col("gwins").cast("long")))
    w = Window.partitionBy("campaign_id").orderBy("day", "kind").rowsBetween(Window.unboundedPreceding, 0)
    run = u.select(
        "campaign_id", "day", "kind", F.sum("wins").over(w).alias("wb"), F.sum("gwins").over(w).alias("gb")
    ).filter(F.col("kind") == 0).drop("kind")
    j = days.join(run, ["campaign_id", "day"])
    initial = F.when(F.col("demand_type") == "guaranteed", F.col("impression_goal").cast("double")).otherwise(
        F.col("budget")
    )
    wins_before = F.col("wb")
    g_before = F.col("gb")
    return j.select(
        "campaign_id",
        "day",
        initial.alias("initial_capacity"),
        wins_before.cast("long").alias("wins_before"),
        (initial - wins_before).alias("remaining_capacity"),
        g_before.cast("long").alias("delivered_before"),
    )


def catalog_day_table(campaigns: DataFrame, ledger: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Catalog x live days with counters, pacing numbers and audience info."""
    cap = capacity_at_day_start(campaigns, ledger, start, end)
    c = campaigns.select(
        "campaign_id", "category", "demand_type", "bid", "impression_goal", "flight_start", "flight_end",
        "targeted_audiences",
    )
    t = cap.join(c, "campaign_id")
    frac = flight_fraction(F.col("day"), F.col("flight_start"), F.col("flight_end"))
    expected = F.col("impression_goal") * frac
    return t.select(
        "*",
        frac.alias("flight_fraction"),
        expected.alias("expected_by_now"),
        (
            (F.col("demand_type") == "guaranteed")
            & behind_schedule(F.col("delivered_before"), F.col("impression_goal"), frac)
        ).alias("behind"),
        F.when(expected > 0, F.col("delivered_before") / expected).otherwise(F.lit(0.0)).alias("urgency"),
        # Wins a behind campaign can take today before it is back on
        # schedule (or out of capacity): linear pacing is judged per day.
        F.greatest(
            F.lit(0),
            F.least(F.ceil(expected - F.col("delivered_before")), F.floor(F.col("remaining_capacity"))),
        ).cast("long").alias("quota"),
    )


def lift_lookup(lift_rules: DataFrame, categories: DataFrame) -> DataFrame:
    """J-11 precomputed over (segment, category, day part): most specific rule
    wins (exact category before exact condition), later rule on ties.
    A category asks for its own rules and for those of '*', by one equi-join."""
    cats = categories.select("category").distinct()
    cats = cats.select("category", F.explode(F.array("category", F.lit("*"))).alias("rule_category"))
    parts = F.explode(F.array(F.lit("day"), F.lit("night"))).alias("day_part")
    j = cats.join(lift_rules.withColumnRenamed("category", "rule_category"), "rule_category")
    j = j.select("*", parts).filter((F.col("cond") == "any") | (F.col("cond") == F.col("day_part")))
    spec = F.struct(
        (F.col("rule_category") != "*").alias("a"), (F.col("cond") != "any").alias("b"), F.col("rule_order")
    )
    return j.groupBy("segment", "category", "day_part").agg(F.max_by("multiplier", spec).alias("lift"))


# ------------------------------------------------------------- request side


def request_context(inp: DecisionInputs, start: dt.date, end: dt.date) -> DataFrame:
    """Per request: arm, model version, user segment and memberships as of
    the previous day (leak-free), live destination, external bid and
    availability flags.

    Columns the request table already carries (bid, health flags) are used
    in place; the destination as-of lookup carries the request columns
    through its window (no join back); the user context is one join on
    (user, day)."""
    r = inp.requests
    have = set(r.columns)
    own = [c for c in ("external_bid", "model_ok", "features_ok", "pacing_ok", "stage_latencies_ms") if c in have]
    base = r.select("request_id", "user_id", "ts", "request_date", "hour_of_day", *own)
    dests = inp.destinations.select("user_id", "ts", F.col("category").alias("destination"))
    out = latest_within(base, dests, "user_id", ["destination"], config.SESSION_TTL_SECONDS, keep_left=True).drop(
        "age_seconds"
    )
    out = out.withColumn("ctx_day", F.date_sub("request_date", 1))
    if inp.user_context is not None:
        uc = inp.user_context.select("user_id", F.col("asof").alias("ctx_day"), "segment", "audience_memberships")
        out = out.join(uc, ["user_id", "ctx_day"], "left")
    else:
        mem = inp.memberships.select("user_id", F.col("asof").alias("ctx_day"), "audience_memberships")
        out = out.join(mem, ["user_id", "ctx_day"], "left").join(
            inp.segments.select("user_id", "segment"), "user_id", "left"
        )
    if "external_bid" not in have:
        if inp.bids is not None:
            out = out.join(inp.bids.select("request_id", F.col("bid").alias("external_bid")), "request_id", "left")
        else:
            out = out.withColumn("external_bid", F.lit(None).cast("double"))
    if inp.availability is not None and "model_ok" not in have:
        out = out.join(inp.availability, "request_id", "left")
    for c in ("model_ok", "features_ok", "pacing_ok"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(True)) if c in out.columns else F.lit(True))
    if "stage_latencies_ms" not in out.columns:
        out = out.withColumn("stage_latencies_ms", F.lit(None).cast("map<string,double>"))
    arm = assign_arm(F.col("user_id"))
    version = F.when(arm == "control", config.ARM_VERSIONS["control"]).otherwise(config.ARM_VERSIONS["treatment"])
    return out.select(
        "request_id", "user_id", "ts", "request_date", "hour_of_day",
        arm.alias("experiment_arm"), version.alias("model_version"), "ctx_day", "segment",
        "audience_memberships", "destination", "external_bid", "model_ok", "features_ok", "pacing_ok",
        "stage_latencies_ms",
    )


def requests_per_live_campaign(req: DataFrame, live: DataFrame) -> DataFrame:
    """J-04 / J-10 without pairs: every campaign live on a day that has
    requests, with the number of the requests that meet it."""
    per_day = req.groupBy(F.col("request_date").alias("day")).agg(F.count("*").alias("n_requests"))
    return live.select("day", "campaign_id").join(per_day, "day")


def audiences_of(targeted) -> Column:
    """Targeted audiences as a key: distinct, in order."""
    return F.array_sort(F.array_distinct(F.coalesce(targeted, F.array().cast("array<string>"))))


def reaches(audiences: Column, members: Column) -> Column:
    """P-07: untargeted, or the user is in one of the audiences."""
    mine = F.coalesce(members, F.array().cast("array<string>"))
    return (F.size(audiences) == 0) | F.coalesce(F.arrays_overlap(audiences, mine), F.lit(False))


def with_capacity(catalog_days: DataFrame) -> DataFrame:
    return catalog_days.filter(F.col("remaining_capacity") > 0)


def candidate_groups(catalog_days: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The catalog with capacity, by (day, targeted audiences, category): the
    campaigns of a group are alike to every request, but for bid and pacing.
    ``by``: further columns in which they have to be alike (ad features)."""
    auction = F.col("demand_type") == "auction"
    offer = F.struct("campaign_id", "bid")
    return (
        with_capacity(catalog_days)
        .groupBy("day", audiences_of(F.col("targeted_audiences")).alias("audiences"), "category", *by)
        .agg(
            F.count("*").alias("campaigns"),
            F.sum("campaign_id").alias("id_sum"),
            F.count_if(auction).alias("auctions"),
            # Equal click probability inside a group: the best eCPM is the best bid's (first id on ties) ...
            F.min_by(offer, F.when(auction, F.struct((-F.coalesce("bid", F.lit(0.0))).alias("k"), "campaign_id"))).alias("best"),
            # ... and the first id's where all eCPMs are zero.
            F.min_by(offer, F.when(auction, F.col("campaign_id"))).alias("first"),
            F.min(F.when(F.col("behind"), F.struct("urgency", "campaign_id", "quota"))).alias("pick"),
        )
    )


def context_index(req: DataFrame, groups: DataFrame, lift: DataFrame) -> DataFrame:
    """Groups of the day with their click probability, one row for every
    (day, segment, day part) that requests have."""
    ctx = ["request_date", "segment", "day_part"]
    rows = req.select(*ctx).distinct().join(groups.withColumnRenamed("day", "request_date"), "request_date")
    rows = rows.join(lift, ["segment", "category", "day_part"], "left")
    group = F.struct(
        "audiences", "category", "campaigns", "id_sum", "auctions", "best", "first", "pick",
        F.coalesce("lift", F.lit(1.0)).alias("lift"),
    )
    return rows.groupBy(*ctx).agg(F.array_sort(F.collect_list(group)).alias("groups"))


#: Parts of a day's catalog where all pairs are made: a day is not one task.
DAY_PARTS = 32


def pairs_of_day(req: DataFrame, catalog_days: DataFrame) -> DataFrame:
    """J-04 / J-10: every request with every catalog row of its day.  The rows
    of a day are dealt into DAY_PARTS parts, each of which meets all requests."""
    r = req.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(DAY_PARTS - 1))))
    c = catalog_days.withColumn("__part", F.pmod(F.xxhash64("campaign_id"), F.lit(DAY_PARTS)).cast("int"))
    return r.join(c, (r.request_date == c.day) & (r["__part"] == c["__part"])).drop("__part", "day")


def eligible_pairs(req: DataFrame, catalog_days: DataFrame) -> DataFrame:
    """D-01 expanded: a row per request and eligible campaign."""
    j = pairs_of_day(req, with_capacity(catalog_days))
    return j.filter(reaches(audiences_of(F.col("targeted_audiences")), F.col("audience_memberships")))


def scored_pairs(req: DataFrame, catalog_days: DataFrame, lift: DataFrame) -> DataFrame:
    """D-04 expanded: click probability and eCPM of every request and eligible
    auction campaign.  The multipliers of a category go with its campaigns, so
    that pairs are not shuffled for them."""
    context = F.struct("segment", "day_part")
    by_category = lift.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct(context, "lift"))).alias("lifts"))
    offers = catalog_days.filter(F.col("demand_type") == "auction").join(by_category, "category", "left")
    j = eligible_pairs(req, offers)
    multiplier = F.coalesce(F.try_element_at("lifts", context), F.lit(1.0))
    pctr = boosted_pctr(click_probability(multiplier), F.col("destination"), F.col("category"))
    return j.select("request_id", "campaign_id", pctr.alias("pctr"), ecpm(F.col("bid"), pctr).alias("ecpm"))


def eligible_by_class(req: DataFrame, catalog_days: DataFrame) -> DataFrame:
    """D-01: requests of a day that are in the same targeted audiences have
    the same candidates.  (request_date, audiences, campaign_id, n_requests):
    the candidates of each such class, and how many requests are in it."""
    c = with_capacity(catalog_days).withColumn("target", audiences_of(F.col("targeted_audiences")))
    # Names of audiences that any campaign of a day targets: configuration, few.
    used = c.select("day", F.explode("target").alias("a")).groupBy("day").agg(F.collect_set("a").alias("used"))
    r = req.join(used, req.request_date == used.day, "left")
    mine = audiences_of(F.array_intersect(F.coalesce("audience_memberships", F.array().cast("array<string>")), F.coalesce("used", F.array().cast("array<string>"))))
    classes = r.groupBy("request_date", mine.alias("mine")).agg(F.count("*").alias("n_requests"))
    j = classes.join(c.select("day", "campaign_id", "target"), F.col("request_date") == F.col("day"))
    return j.filter(reaches(F.col("target"), F.col("mine"))).select(
        "request_date", F.array_join("mine", ",").alias("audiences"), "campaign_id", "n_requests"
    )


def exclusions(req: DataFrame, catalog_days: DataFrame, audiences: list[config.Audience]) -> DataFrame:
    """D-02: targeted campaigns that passed status, flight and capacity but
    failed the audience rule: one row per targeted audience with its
    definition version (-1 when the audience is unknown).  Only targeted
    campaigns take part."""
    c = with_capacity(catalog_days).select("day", "campaign_id", audiences_of(F.col("targeted_audiences")).alias("target"))
    c = c.filter(F.size("target") > 0)
    j = req.select("request_id", "request_date", "audience_memberships").join(c, F.col("request_date") == F.col("day"))
    ex = j.filter(~reaches(F.col("target"), F.col("audience_memberships"))).select(
        "request_id", "campaign_id", F.explode("target").alias("audience")
    )
    return ex.select("request_id", "campaign_id", "audience", _version(audiences)(F.col("audience")).alias("definition_version"))


def _version(audiences: list[config.Audience]) -> Callable[[Column], Column]:
    if not audiences:
        return lambda a: F.lit(-1).cast("long")
    known = F.create_map(*[x for a in audiences for x in (F.lit(a.name), F.lit(a.version).cast("long"))])
    return lambda a: F.coalesce(F.try_element_at(known, a), F.lit(-1).cast("long"))


def model_rows(req: DataFrame, groups: DataFrame) -> DataFrame:
    """E-05 input: a row per request and eligible auction group (campaigns of
    a group have equal ad features, so one score holds for all of them)."""
    g = groups.filter("auctions > 0").withColumnRenamed("day", "request_date")
    j = req.select(
        "request_id", "user_id", "request_date", "hour_of_day", "experiment_arm", "audience_memberships", "destination",
        F.col("ctx_day").alias("asof"),
    ).join(g, "request_date")
    j = j.filter(reaches(F.col("audiences"), F.col("audience_memberships"))).drop("audience_memberships", "pick", "campaigns", "id_sum")
    return j.withColumn("campaign_id", F.col("best.campaign_id"))


def quota_capped(pick: DataFrame) -> DataFrame:
    """Keep a guaranteed pick only while its campaign still has quota that
    day, in request time order; overflow requests go on to the auction.

    The rank inside (campaign, day) is built in two levels so no single
    task sorts a hot campaign's whole day: per-minute counts give each
    minute its offset (<= 1,440 rows per campaign-day), then the rank inside
    the (campaign, day, minute) partition is added to it."""
    p = pick.withColumn("minute", F.floor(F.unix_seconds("ts") / 60))
    per_min = p.groupBy("g_winner", "request_date", "minute").agg(F.count("*").alias("n"))
    wo = Window.partitionBy("g_winner", "request_date").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_min.select("g_winner", "request_date", "minute", F.coalesce(F.sum("n").over(wo), F.lit(0)).alias("off"))
    wi = Window.partitionBy("g_winner", "request_date", "minute").orderBy("ts", "request_id")
    ranked = p.withColumn("r", F.row_number().over(wi)).join(offs, ["g_winner", "request_date", "minute"])
    return ranked.filter(F.col("off") + F.col("r") <= F.col("quota")).drop("minute", "off", "r")


def popularity_ranking(campaigns: DataFrame, ad_ctr_30d: DataFrame) -> DataFrame:
    """K-01: campaigns by ad_ctr_30d desc (missing 0.0), catalog order on ties."""
    j = campaigns.select("campaign_id").join(ad_ctr_30d, "campaign_id", "left")
    j = j.select("campaign_id", (-F.coalesce("ad_ctr_30d", F.lit(0.0))).alias("rank_key"))
    return row_numbers(j, ["rank_key", "campaign_id"], "popularity_rank").select("campaign_id", "popularity_rank")


def catalog_only_days(campaigns: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """P-08 per day: active, in flight and targeting no audience at all."""
    return live_days(campaigns, start, end).filter(F.size("targeted_audiences") == 0).select("campaign_id", "day")


def popularity_fallback(campaigns: DataFrame, ranking: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """K-02: per day, the top-ranked campaign that is catalog-only eligible."""
    j = catalog_only_days(campaigns, start, end).join(ranking, "campaign_id")
    return j.groupBy("day").agg(F.min_by("campaign_id", "popularity_rank").alias("fallback_campaign_id"))


def arbitration_outcome(per: DataFrame, ok) -> DataFrame:
    """D-05 on per-request rows (request_id, request_date, ts, external_bid,
    best, pick): quota-capped guaranteed pick, else external bid strictly
    above the best eCPM, else best eCPM, else none.  Adds winner, rung, price."""
    picks = per.filter(ok & F.col("pick").isNotNull()).select(
        "request_id", "request_date", "ts", F.col("pick.campaign_id").alias("g_winner"), F.col("pick.quota").alias("quota")
    )
    kept = quota_capped(picks).select("request_id", "g_winner")
    d = per.join(kept, "request_id", "left")
    best_ecpm = F.coalesce(F.col("best.ecpm"), F.lit(0.0))
    ext = F.col("external_bid").isNotNull() & (F.col("external_bid") > best_ecpm)
    winner = (
        F.when(F.col("g_winner").isNotNull(), F.col("g_winner"))
        .when(ext, F.lit(None).cast("long"))
        .when(F.col("best").isNotNull(), F.col("best.campaign_id"))
    )
    rung = (
        F.when(F.col("g_winner").isNotNull(), F.lit("guaranteed"))
        .when(ext, F.lit("external"))
        .when(F.col("best").isNotNull(), F.lit("auction"))
        .otherwise(F.lit("none"))
    )
    price = (
        F.when(F.col("g_winner").isNotNull(), F.lit(None).cast("double"))
        .when(ext, F.col("external_bid"))
        .when(F.col("best").isNotNull(), F.col("best.ecpm"))
    )
    return d.select("*", winner.alias("winner"), rung.alias("rung"), price.alias("price"))


def scored_groups(eligible: Column, destination: Column) -> Column:
    """D-04: one entry per eligible auction group: its best campaign."""

    def entry(g: Column) -> Column:
        pctr = boosted_pctr(click_probability(g["lift"]), destination, g["category"])
        value = ecpm(g["best"]["bid"], pctr)
        offer = F.when(F.coalesce(value, F.lit(0.0)) == 0, g["first"]).otherwise(g["best"])
        features = F.create_map(
            F.lit("lift"), g["lift"], F.lit("destination_match"), F.coalesce((destination == g["category"]).cast("double"), F.lit(0.0))
        )
        return F.struct(
            g["audiences"].alias("audiences"), g["category"].alias("category"), g["auctions"].alias("campaigns"),
            offer["campaign_id"].alias("campaign_id"), pctr.alias("pctr"), ecpm(offer["bid"], pctr).alias("ecpm"),
            features.alias("features"),
        )

    return F.transform(F.filter(eligible, lambda g: g["auctions"] > 0), entry)


def model_scores(inp: DecisionInputs, req: DataFrame, cat: DataFrame) -> DataFrame:
    """(request_id, scores) from the scorer: campaigns with equal ad features
    are scored once a request.  A missing score is an error."""
    names = [c for c in inp.ad_features.columns if c not in ("campaign_id", "day")]
    groups = materialize(candidate_groups(cat.join(inp.ad_features, ["campaign_id", "day"], "left"), tuple(names)))
    rows = inp.scorer(model_rows(req, groups))
    missing = F.raise_error(F.lit("an eligible candidate has no model score")).cast("double")
    pctr = boosted_pctr(F.coalesce("pctr", missing), F.col("destination"), F.col("category"))
    used = [c for c in config.V1_FEATURES if c in rows.columns]
    rows = rows.withColumn("pctr", pctr).withColumn("value", ecpm(F.col("best.bid"), F.col("pctr")))
    rows = rows.withColumn("offer", F.when(F.coalesce("value", F.lit(0.0)) == 0, F.col("first")).otherwise(F.col("best")))
    score = F.struct(
        "audiences", "category", F.col("auctions").alias("campaigns"), F.col("offer.campaign_id").alias("campaign_id"), "pctr",
        ecpm(F.col("offer.bid"), F.col("pctr")).alias("ecpm"),
        F.create_map(*[x for c in used for x in (F.lit(c), F.col(c).cast("double"))]).alias("features"),
    )
    return rows.groupBy("request_id").agg(F.collect_list(score).alias("scores"))


def contexts(inp: DecisionInputs, start: dt.date, end: dt.date) -> DataFrame:
    """The requests with all that the decision job knows of them."""
    return request_context(inp, start, end).withColumn("day_part", day_part(F.col("hour_of_day")))


def fallback_days(inp: DecisionInputs, start: dt.date, end: dt.date) -> DataFrame | None:
    """K-02 of every day, if there is a ranking: one row per day."""
    return None if inp.popularity is None else popularity_fallback(inp.campaigns, inp.popularity, start, end)


def decide(inp: DecisionInputs, start: dt.date, end: dt.date) -> dict[str, DataFrame]:
    """Run the whole decision job.  Returns the intermediate frames and the
    final ``decisions`` (one row per request, nested record D-09).

    Shape: request context (written once) -> equi-join with the context index
    -> eligible and excluded groups, scores, best eCPM and most urgent
    guaranteed pick as expressions over the row's groups -> quota cap on the
    guaranteed picks -> arbitration and fallback ladder as columns."""
    req = materialize(contexts(inp, start, end))
    return decide_contexts(inp, req, lift_lookup(inp.lift_rules, inp.campaigns), fallback_days(inp, start, end), start, end)


def decide_contexts(
    inp: DecisionInputs, req: DataFrame, lift: DataFrame, fallback_of_day: DataFrame | None, start: dt.date, end: dt.date
) -> dict[str, DataFrame]:
    """:func:`decide` for requests whose context, multipliers and fallback
    are known: none of them depends on the ledger."""
    audiences = inp.audiences or []
    cat = catalog_day_table(inp.campaigns, inp.ledger, start, end)
    if inp.granted is not None:
        cat = cat.join(inp.granted, ["campaign_id", "day"], "left").withColumn(
            "quota", F.greatest(F.lit(0).cast("long"), F.col("quota") - F.coalesce("granted", F.lit(0)))
        ).drop("granted")
    cat = materialize(cat)
    groups = materialize(candidate_groups(cat))
    index = materialize(context_index(req, groups, lift))
    same = (
        (F.col("r.request_date") == F.col("i.request_date"))
        & F.col("r.segment").eqNullSafe(F.col("i.segment"))
        & F.col("r.day_part").eqNullSafe(F.col("i.day_part"))
    )
    per = req.alias("r").join(index.alias("i"), same, "left").select("r.*", "i.groups")
    per = per.withColumn("groups", F.coalesce("groups", F.array().cast(index.schema["groups"].dataType)))
    fits = lambda g: reaches(g["audiences"], F.col("audience_memberships"))
    per = per.withColumns({"ok": F.filter("groups", fits), "out": F.filter("groups", lambda g: ~fits(g))}).drop("groups")
    if inp.scorer is None:
        per = per.withColumn("scores", scored_groups(F.col("ok"), F.col("destination")))
    else:
        found = model_scores(inp, req, cat)
        none = F.array().cast(found.schema["scores"].dataType)
        per = per.join(found, "request_id", "left").withColumn("scores", F.coalesce("scores", none))
    offer = F.transform("scores", lambda s: F.struct((-F.coalesce(s["ecpm"], F.lit(0.0))).alias("k"), s["campaign_id"].alias("campaign_id"), s["ecpm"].alias("ecpm")))
    picks = F.transform(F.filter("ok", lambda g: g["pick"].isNotNull()), lambda g: g["pick"])
    version = _version(audiences)
    per = per.select(
        "request_id", "user_id", "ts", "request_date", "ctx_day", "experiment_arm", "model_version", "external_bid",
        "model_ok", "features_ok", "pacing_ok", "stage_latencies_ms",
        F.transform("ok", lambda g: F.struct(
            g["audiences"].alias("audiences"), g["category"].alias("category"), g["campaigns"].alias("campaigns"), g["id_sum"].alias("id_sum")
        )).alias("candidate_set"),
        F.flatten(F.transform("out", lambda g: F.transform(g["audiences"], lambda a: F.struct(
            g["audiences"].alias("audiences"), g["category"].alias("category"), a.alias("audience"),
            version(a).alias("definition_version"), g["campaigns"].alias("campaigns"),
        )))).alias("audience_exclusions"),
        "scores", F.array_min(offer).alias("best"), F.array_min(picks).alias("pick"),
    )
    ok = F.col("model_ok") & F.col("features_ok") & F.col("pacing_ok")
    d = arbitration_outcome(materialize(per), ok)
    winner, rung, price = F.col("winner"), F.col("rung"), F.col("price")
    fallback = (
        F.when(~F.col("model_ok"), F.lit(RUNG_MODEL_DOWN))
        .when(~F.col("features_ok"), F.lit(RUNG_FEATURES_DOWN))
        .when(~F.col("pacing_ok"), F.lit(RUNG_PACING_DOWN))
    )
    if fallback_of_day is not None:
        d = d.join(fallback_of_day, d.request_date == fallback_of_day.day, "left").drop("day")
    else:
        d = d.withColumn("fallback_campaign_id", F.lit(None).cast("long"))
    d = d.withColumn("fallback_rung", fallback)
    full = F.col("fallback_rung").isNull()
    decisions = d.select(
        "request_id", "user_id", "ts", "request_date", "experiment_arm", "model_version",
        F.when(full, F.col("candidate_set")).alias("candidate_set"),
        F.when(full, F.col("audience_exclusions")).alias("audience_exclusions"),
        F.when(full, F.col("scores")).alias("scores"),
        F.when(full, F.col("ctx_day")).alias("features_as_of"),
        F.when(full, F.unix_seconds("ts") - F.unix_seconds(F.date_add("ctx_day", 1).cast("timestamp"))).alias("feature_age_seconds"),
        "stage_latencies_ms",
        F.when(~full, F.lit(None).cast("string"))
        .when(F.col("external_bid").isNotNull(), F.lit("bid"))
        .otherwise(F.lit("no_bid"))
        .alias("external_bid_outcome"),
        F.when(full, F.col("external_bid")).alias("external_bid"),
        F.when(F.col("fallback_rung") == RUNG_MODEL_DOWN, F.lit(config.HOUSE_AD_ID).cast("long"))
        .when(~full, F.col("fallback_campaign_id"))
        .otherwise(winner)
        .alias("winner"),
        F.coalesce(F.col("fallback_rung"), rung).alias("rung"),
        F.when(full, price).alias("price"),
        "fallback_rung",
    )
    return {
        "requests": req,
        "catalog_days": cat,
        "groups": groups,
        "index": index,
        "eligible": eligible_pairs(req, cat),
        "exclusions": exclusions(req, cat, audiences),
        "scored_pairs": scored_pairs(req, cat, lift) if inp.scorer is None else None,
        "scored": per.select("request_id", F.explode("scores").alias("s")).select("request_id", "s.*"),
        "arbitrated": decisions.filter(F.col("fallback_rung").isNull()).select("request_id", "winner", "rung", "price"),
        "decisions": decisions,
    }


def decremented(decisions: DataFrame) -> DataFrame:
    """Wins that decrement a counter: guaranteed or auction rung (fallback
    wins are served but never decremented)."""
    return decisions.filter(F.col("winner").isNotNull() & F.col("rung").isin("guaranteed", "auction"))


def ledger_from_decisions(decisions: DataFrame) -> DataFrame:
    """Delivery ledger rows (campaign, day, wins, guaranteed_wins) from a
    decision log: the replay's own counters."""
    dec = decremented(decisions)
    return dec.groupBy(F.col("winner").alias("campaign_id"), F.col("request_date").alias("day")).agg(
        F.count("*").alias("wins"), F.count_if(F.col("rung") == "guaranteed").alias("guaranteed_wins")
    )


def ledger_from_impressions(ad_events: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Fixture ledger: every logged impression was one delivered win (and a
    guaranteed delivery for guaranteed campaigns)."""
    imps = ad_events.filter(F.col("event_type") == "impression").groupBy(
        "campaign_id", F.col("event_date").alias("day")
    ).agg(F.count("*").alias("wins"))
    return imps.join(campaigns.select("campaign_id", "demand_type"), "campaign_id").select(
        "campaign_id", "day", "wins",
        F.when(F.col("demand_type") == "guaranteed", F.col("wins")).otherwise(F.lit(0)).cast("long").alias("guaranteed_wins"),
    )


def granted_wins(decisions: DataFrame) -> DataFrame:
    """Guaranteed wins per (campaign, day) of a log: what a later batch of the
    same day finds taken from the day's quota."""
    return decisions.filter(F.col("rung") == "guaranteed").groupBy(
        F.col("winner").alias("campaign_id"), F.col("request_date").alias("day")
    ).agg(F.count("*").alias("granted"))


def pacing_status(decisions: DataFrame, campaigns: DataFrame, as_of: dt.date) -> DataFrame:
    """D-06: per guaranteed campaign, delivered = guaranteed wins in the log,
    flight fraction, expected by as_of, behind-schedule flag."""
    g = campaigns.filter(F.col("demand_type") == "guaranteed")
    dl = decisions.filter(F.col("rung") == "guaranteed").groupBy(F.col("winner").alias("campaign_id")).agg(
        F.count("*").alias("delivered")
    )
    j = g.join(dl, "campaign_id", "left")
    frac = flight_fraction(lit_date(as_of), F.col("flight_start"), F.col("flight_end"))
    delivered = F.coalesce("delivered", F.lit(0)).cast("long")
    return j.select(
        "campaign_id",
        "impression_goal",
        delivered.alias("delivered"),
        frac.alias("flight_fraction"),
        (F.col("impression_goal") * frac).alias("expected_by_now"),
        behind_schedule(delivered, F.col("impression_goal"), frac).alias("behind_schedule"),
    )


def remaining_capacity(decisions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """D-03 after a log: initial - decremented wins, for campaigns with wins."""
    dec = decremented(decisions).groupBy(F.col("winner").alias("campaign_id")).agg(
        F.count("*").alias("decremented_wins")
    )
    initial = F.when(F.col("demand_type") == "guaranteed", F.col("impression_goal").cast("double")).otherwise(
        F.col("budget")
    )
    return campaigns.join(dec, "campaign_id").select(
        "campaign_id", "demand_type", initial.alias("initial_capacity"), "decremented_wins",
        (initial - F.col("decremented_wins")).alias("remaining_capacity"),
    )


def decide_in_days(inp: DecisionInputs, start: dt.date, end: dt.date, log: str) -> DataFrame:
    """D-08: the decision job day after day, each day with the wins that the
    days before it logged.  The ledger is read from the written log; inside a
    day the quota rule holds.  What does not depend on the log (contexts of the
    requests, multipliers, fallbacks, the catalog) is computed once for all days."""
    from adlake.sources import decision_log as dlog

    spark = inp.requests.sparkSession
    inp = replace(inp, requests=inp.requests.filter(F.col("request_date").between(lit_date(start), lit_date(end))), campaigns=materialize(inp.campaigns))
    # In order of days: a day reads its own part of the files.
    req = materialize(contexts(inp, start, end).repartitionByRange("request_date", "request_id"))
    lift = materialize(lift_lookup(inp.lift_rules, inp.campaigns))
    fallback = fallback_days(inp, start, end)
    fallback = fallback if fallback is None else materialize(fallback)
    earlier = materialize(inp.ledger.filter(F.col("day") < lit_date(start)))
    for n in range((end - start).days + 1):
        day = start + dt.timedelta(days=n)
        ledger = earlier.unionByName(ledger_from_decisions(dlog.read(spark, log)))
        today = req.filter(F.col("request_date") == lit_date(day))
        dlog.append(decide_contexts(replace(inp, ledger=ledger), today, lift, fallback, day, day)["decisions"], log)
    return dlog.read(spark, log)
