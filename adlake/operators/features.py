"""Batch feature jobs (A-01 .. A-06, A-12 .. A-15, P-01 .. P-06, J-01, J-02,
J-12) and the one-pass rolling backfill (W-01).

Every job is a declarative aggregate over one scan of the event table.
Conditional counts (``count_if``) replace the reference's separate
impression / click frames plus left join (J-01): one shuffle instead of
three, and partial (map-side) aggregation absorbs hot users / campaigns
before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import account_age_days, all_of, in_window, lit_date, rule_predicate
from adlake.session import materialize

def IMP() -> Column:
    return F.col("event_type") == "impression"


def CLK() -> Column:
    return F.col("event_type") == "click"


def events_in_window(events: DataFrame, as_of: dt.date, window_days: int, date_col: str = "event_date") -> DataFrame:
    """P-01."""
    return events.filter(in_window(date_col, as_of, window_days))


def ctr_overall(events: DataFrame, as_of: dt.date, window_days: int, key: str, name: str = "ctr") -> DataFrame:
    """A-01: clicks / impressions per key in the window; only keys with
    impressions.  Clicks are dated by their own event_date."""
    w = events_in_window(events, as_of, window_days)
    agg = w.groupBy(key).agg(F.count_if(IMP()).alias("impressions"), F.count_if(CLK()).alias("clicks"))
    return agg.filter(F.col("impressions") > 0).select(
        key, (F.col("clicks") / F.col("impressions")).alias(name)
    )


def ctr_by_left_join(events: DataFrame, as_of: dt.date, window_days: int, key: str) -> DataFrame:
    """J-01 written literally: impression counts left join click counts, 0 fill.
    Kept as the reference shape; ctr_overall is the one-shuffle form."""
    w = events_in_window(events, as_of, window_days)
    imps = w.filter(IMP()).groupBy(key).agg(F.count("*").alias("impressions"))
    clks = w.filter(CLK()).groupBy(key).agg(F.count("*").alias("clicks"))
    out = imps.join(clks, key, "left").fillna(0, ["clicks"])
    return out.select(key, "impressions", "clicks", (F.col("clicks") / F.col("impressions")).alias("ctr"))


def ctr_by_category(events: DataFrame, as_of: dt.date, window_days: int) -> DataFrame:
    """A-02: (user_id, category, ctr)."""
    w = events_in_window(events, as_of, window_days)
    agg = w.groupBy("user_id", "category").agg(
        F.count_if(IMP()).alias("impressions"), F.count_if(CLK()).alias("clicks")
    )
    return agg.filter(F.col("impressions") > 0).select(
        "user_id", "category", (F.col("clicks") / F.col("impressions")).alias("ctr")
    )


def impressions_count(events: DataFrame, as_of: dt.date, window_days: int, key: str, name: str) -> DataFrame:
    """A-03: impression count per key (long)."""
    w = events_in_window(events, as_of, window_days).filter(IMP())
    return w.groupBy(key).agg(F.count("*").alias(name))


def rides_count(rides: DataFrame, as_of: dt.date, window_days: int = 7) -> DataFrame:
    """A-04: user_rides_per_week as double; users without rides absent."""
    w = rides.filter(in_window("ride_date", as_of, window_days))
    return w.groupBy("user_id").agg(F.count("*").cast("double").alias("user_rides_per_week"))


def spend_yesterday(events: DataFrame, campaigns: DataFrame, as_of: dt.date) -> DataFrame:
    """A-05 + J-12: auction = impressions on as_of - 1 x bid (0 if none);
    guaranteed = 0.0; every campaign of any status present."""
    y = as_of - dt.timedelta(days=1)
    imps = (
        events.filter(IMP() & (F.col("event_date") == lit_date(y)))
        .groupBy("campaign_id")
        .agg(F.count("*").alias("imps"))
    )
    c = campaigns.select("campaign_id", "demand_type", "bid")
    return c.join(imps, "campaign_id", "left").select(
        "campaign_id",
        F.when(F.col("demand_type") == "auction", F.coalesce(F.col("imps"), F.lit(0)) * F.col("bid"))
        .otherwise(F.lit(0.0))
        .alias("campaign_spend_yesterday"),
    )


def ctr_by_category_map(events: DataFrame, as_of: dt.date, window_days: int = 30) -> DataFrame:
    """A-06 (map form): user_ctr_by_category_30d as map<category, ctr>."""
    cat = ctr_by_category(events, as_of, window_days)
    return cat.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("category", "ctr"))).alias("user_ctr_by_category_30d")
    )


def account_age(users: DataFrame, as_of: dt.date) -> DataFrame:
    """P-10."""
    return users.select("user_id", account_age_days("created_at", as_of).alias("user_account_age_days"))


# ---------------------------------------------------------------- audiences


def rule_feature_col(feature: str) -> Column:
    """Column for an audience rule's feature name (dotted = map lookup)."""
    if feature.startswith("user_ctr_by_category_30d."):
        cat = feature.split(".", 1)[1]
        return F.coalesce(F.try_element_at(F.col("user_ctr_by_category_30d"), F.lit(cat)), F.lit(0.0))
    if feature == "user_rides_per_week":
        return F.coalesce(F.col("user_rides_per_week"), F.lit(0.0))
    return F.col(feature)


def audience_match_cols(audiences: list[config.Audience]) -> list[tuple[str, Column]]:
    """P-06: one boolean Column per audience, rules ANDed."""
    return [
        (a.name, all_of([rule_predicate(rule_feature_col(f), op, v) for f, op, v in a.rules])) for a in audiences
    ]


def audience_context(users: DataFrame, events: DataFrame, rides: DataFrame, as_of: dt.date) -> DataFrame:
    """A-13: every user with segment, rides per week and category CTR map,
    missing values 0 (applied when rules read them)."""
    r = rides_count(rides, as_of, 7)
    m = ctr_by_category_map(events, as_of, 30)
    return (
        users.select("user_id", "segment")
        .join(r, "user_id", "left")
        .join(m, "user_id", "left")
        .select(
            "user_id",
            "segment",
            F.coalesce("user_rides_per_week", F.lit(0.0)).alias("user_rides_per_week"),
            F.coalesce("user_ctr_by_category_30d", F.create_map().cast("map<string,double>")).alias(
                "user_ctr_by_category_30d"
            ),
        )
    )


def memberships(context: DataFrame, audiences: list[config.Audience]) -> DataFrame:
    """A-12: per user the matching audiences in definition order, [] not null."""
    cols = audience_match_cols(audiences)
    arr = F.array(*[F.when(c, F.lit(n)) for n, c in cols]) if cols else F.array().cast("array<string>")
    return context.select("user_id", F.filter(arr, lambda x: x.isNotNull()).alias("audience_memberships"))


def membership_long(mem: DataFrame) -> DataFrame:
    """(user_id, audience) long form."""
    return mem.select("user_id", F.explode("audience_memberships").alias("audience"))


def audience_bitmaps(mem: DataFrame) -> DataFrame:
    """(audience, bucket, bits): the members of an audience as bitmaps of the
    users of a bucket, built map-side and merged."""
    long = mem.select("user_id", F.explode(F.array_distinct("audience_memberships")).alias("audience"))
    return long.groupBy("audience", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("bits")
    )


def audience_reach(mem: DataFrame, names: list[str]) -> DataFrame:
    """A-14: members per audience (audiences with members only) and total
    users: one aggregate, in which every user also counts under no name."""
    everyone = F.array(F.lit(None).cast("string"))
    each = F.concat(F.array_intersect("audience_memberships", F.array(*map(F.lit, names))), everyone)
    n = mem.select(F.explode(each).alias("audience")).groupBy("audience").agg(F.count("*").alias("members"))
    total = F.max(F.when(F.col("audience").isNull(), F.col("members"))).over(Window.partitionBy(F.lit(1)))  # a row per audience
    return n.withColumn("total_users", total).filter(F.col("audience").isNotNull())


def audience_overlap(mem: DataFrame, names: list[str]) -> DataFrame:
    """A-15: for each sorted pair (a < b) of non-empty audiences, the size of
    the intersection, zeros kept.  Bitmaps of a bucket are intersected pair by
    pair; the plan is the same for any number of audiences."""
    bits = materialize(audience_bitmaps(mem).filter(F.col("audience").isin(*names)))
    side = lambda x: bits.select(F.col("audience").alias(f"audience_{x}"), "bucket", F.col("bits").alias(x))
    both = side("a").join(side("b"), "bucket").filter("audience_a < audience_b")
    one = F.explode(F.array("a", "b")).alias("bits")
    shared = both.select("audience_a", "audience_b", "bucket", one).groupBy("audience_a", "audience_b", "bucket").agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("n")
    )
    # Every pair of audiences that have members (names: configuration).
    held = bits.groupBy(F.lit(1).alias("one")).agg(F.array_sort(F.collect_set("audience")).alias("held"))
    pairs = held.select(F.explode("held").alias("audience_a"), "held").select("audience_a", F.explode("held").alias("audience_b"))
    zero = pairs.filter("audience_a < audience_b").withColumn("n", F.lit(0).cast("long"))
    return shared.select("audience_a", "audience_b", "n").unionByName(zero).groupBy("audience_a", "audience_b").agg(F.sum("n").alias("overlap"))


def reach_report(mem: DataFrame, names: list[str]) -> DataFrame:
    """R-03: member rows and overlap rows, each with total users."""
    reach = audience_reach(mem, names).select(
        F.lit("members").alias("kind"), F.col("audience").alias("audience_a"), F.lit(None).cast("string").alias("audience_b"),
        F.col("members").alias("n"), "total_users",
    )
    overlap = audience_overlap(mem, names).select(
        F.lit("overlap").alias("kind"), "audience_a", "audience_b", F.col("overlap").alias("n"), F.lit(None).cast("long").alias("total_users")
    )
    both = reach.unionByName(overlap)  # a row per audience and per pair
    return both.withColumn("total_users", F.max("total_users").over(Window.partitionBy(F.lit(1))))


# ----------------------------------------------------------- snapshot / merge


def merge_entity_frames(frames: list[DataFrame], key: str) -> DataFrame:
    """J-02: full outer merge of job outputs on the entity id.

    Implemented as union of the frames (each padded to all columns) and a
    single groupBy(key) with first(ignorenulls): one shuffle, not N joins."""
    cols: list[str] = []
    types: dict[str, str] = {}
    for f in frames:
        for name, typ in f.dtypes:
            if name != key and name not in cols:
                cols.append(name)
                types[name] = typ
    padded = []
    for f in frames:
        have = set(f.columns)
        padded.append(
            f.select(key, *[(F.col(c) if c in have else F.lit(None).cast(types[c])).alias(c) for c in cols])
        )
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def ad_snapshot(ad_events: DataFrame, campaigns: DataFrame, as_of: dt.date) -> DataFrame:
    """All ad features as of a day, from one aggregate over the window."""
    w = events_in_window(ad_events, as_of, 30)
    in7 = in_window("event_date", as_of, 7)
    yday = F.col("event_date") == lit_date(as_of - dt.timedelta(days=1))
    agg = w.groupBy("campaign_id").agg(
        F.count_if(IMP()).alias("imps30"),
        F.count_if(CLK()).alias("clicks30"),
        F.count_if(IMP() & in7).alias("imps7"),
        F.count_if(CLK() & in7).alias("clicks7"),
        F.count_if(IMP() & yday).alias("imps_y"),
    )
    c = campaigns.select("campaign_id", "demand_type", "bid")
    return c.join(agg, "campaign_id", "full").select(
        "campaign_id",
        F.when(F.col("imps7") > 0, F.col("clicks7") / F.col("imps7")).alias("ad_ctr_7d"),
        F.when(F.col("imps30") > 0, F.col("clicks30") / F.col("imps30")).alias("ad_ctr_30d"),
        F.when(F.col("imps7") > 0, F.col("imps7")).alias("ad_impressions_7d"),
        F.when(F.col("demand_type") == "auction", F.coalesce("imps_y", F.lit(0)) * F.col("bid"))
        .when(F.col("demand_type") == "guaranteed", F.lit(0.0))
        .alias("campaign_spend_yesterday"),
    )


# ------------------------------------------------------------ W-01 backfill


def rolling_days(
    daily: DataFrame, keys: list[str], frames: dict[str, tuple[str, int, int]], start: dt.date, end: dt.date,
    entities: DataFrame | None = None,
) -> DataFrame:
    """W-01: for every key and day in [start, end], sums of daily measures
    over the days between ``lo`` and ``hi`` days back (``frames``: name ->
    column, lo, hi).  ``entities`` (a row per key, with attributes) are there
    on every day; other keys on days when a frame holds a row.

    Daily rows meet their key once: a key's rows (at most one a day) are put
    into one array, the days of the result are added behind the shuffle, and
    all frames are range frames of one sort by day."""
    measures = sorted({c for c, _, _ in frames.values()})
    attrs = [c for c in (entities.columns if entities is not None else []) if c not in keys]
    far = max(hi for _, _, hi in frames.values())
    first = start - dt.timedelta(days=far)
    rows = daily.filter(F.col("event_date").between(lit_date(first), lit_date(end)))
    day = lambda c: F.datediff(c, lit_date(start))
    of_day = F.struct(
        day(F.col("event_date")).alias("day"), F.lit(False).alias("spine"), *(F.col(c).cast("long").alias(c) for c in measures)
    )
    rows = rows.select(*keys, of_day.alias("r"))
    kind = rows.schema["r"].dataType
    about = F.struct(F.lit(1).alias("known"), *attrs)
    if entities is None:
        rows = rows.withColumn("a", F.lit(None).cast("struct<known:int>"))
    else:
        known = entities.select(*keys, F.lit(None).cast(kind).alias("r"), about.alias("a"))
        rows = rows.withColumn("a", F.lit(None).cast(known.schema["a"].dataType)).unionByName(known)
    per = rows.groupBy(*keys).agg(F.first("a", ignorenulls=True).alias("a"), F.collect_list("r").alias("rows"))
    spine = F.transform(
        F.sequence(F.lit(0), day(lit_date(end))),
        lambda d: F.struct(d.alias("day"), F.lit(True).alias("spine"), *(F.lit(None).cast("long").alias(c) for c in measures)),
    )
    x = per.select(*keys, "a", F.explode(F.concat("rows", spine)).alias("r")).select(*keys, "a", "r.*")
    w = Window.partitionBy(*keys).orderBy("day")
    sums = {n: F.coalesce(F.sum(c).over(w.rangeBetween(-hi, -lo)), F.lit(0)) for n, (c, lo, hi) in frames.items()}
    held = F.count_if(~F.col("spine")).over(w.rangeBetween(-far, 0))
    x = x.select(*keys, "a", "day", "spine", held.alias("held"), *(c.alias(n) for n, c in sums.items()))
    x = x.filter(F.col("spine") & (F.col("a").isNotNull() | (F.col("held") > 0)))
    return x.select(
        *keys, F.date_add(lit_date(start), F.col("day")).alias("asof"), *(F.col("a")[c].alias(c) for c in attrs), *frames
    )


@dataclass(frozen=True)
class FeatureSpec:
    """X-01: a batch feature declares its entity, daily measure and window;
    the framework composes every declared feature of an entity into ONE
    exploded pass (W-01).  Measures:
      ctr              clicks / impressions in the window (only with impressions)
      impressions      impression count (absent when 0)
      rides            ride count as double (absent when 0)
      spend_yesterday  auction: impressions on as_of - 1 x bid; guaranteed: 0.0
    """

    name: str
    entity: str
    measure: str
    window_days: int


# The registry's event-derived batch features (windows from config.REGISTRY).
FEATURE_SPECS = [
    FeatureSpec("user_ctr_30d", "user", "ctr", 30),
    FeatureSpec("user_impressions_7d", "user", "impressions", 7),
    FeatureSpec("user_rides_per_week", "user", "rides", 7),
    FeatureSpec("ad_ctr_7d", "ad", "ctr", 7),
    FeatureSpec("ad_ctr_30d", "ad", "ctr", 30),
    FeatureSpec("ad_impressions_7d", "ad", "impressions", 7),
    FeatureSpec("campaign_spend_yesterday", "ad", "spend_yesterday", 1),
]


def _spec_frames(specs: list[FeatureSpec]) -> dict[str, tuple[str, int, int]]:
    """Window sums that the specs need, one per distinct (measure, window)."""
    need: dict[str, tuple[str, int, int]] = {}
    for s in specs:
        w = s.window_days
        if s.measure == "ctr":
            need[f"imps_{w}"], need[f"clicks_{w}"] = ("imps", 0, w - 1), ("clicks", 0, w - 1)
        elif s.measure == "impressions":
            need[f"imps_{w}"] = ("imps", 0, w - 1)
        elif s.measure == "rides":
            need[f"rides_{w}"] = ("rides", 0, w - 1)
        elif s.measure == "spend_yesterday":
            need["imps_y"] = ("imps", 1, 1)
        else:
            raise ValueError(f"unknown measure {s.measure!r}")
    return need


def _spec_output(s: FeatureSpec) -> Column:
    w = s.window_days
    if s.measure == "ctr":
        return F.when(F.col(f"imps_{w}") > 0, F.col(f"clicks_{w}") / F.col(f"imps_{w}")).alias(s.name)
    if s.measure == "impressions":
        return F.when(F.col(f"imps_{w}") > 0, F.col(f"imps_{w}")).alias(s.name)
    if s.measure == "rides":
        return F.when(F.col(f"rides_{w}") > 0, F.col(f"rides_{w}").cast("double")).alias(s.name)
    return (
        F.when(F.col("demand_type") == "auction", F.coalesce("imps_y", F.lit(0)) * F.col("bid"))
        .when(F.col("demand_type") == "guaranteed", F.lit(0.0))
        .alias(s.name)
    )


def compose_backfill(
    daily: DataFrame, key: str, entities: DataFrame, specs: list[FeatureSpec], start: dt.date, end: dt.date
) -> DataFrame:
    """W-01 for any set of specs: daily (key, event_date, imps, clicks, rides)
    rows and entities -> every entity on every day with its features."""
    x = rolling_days(daily, [key], _spec_frames(specs), start, end, entities)
    return x.select(key, "asof", *[c for c in entities.columns if c != key], *[_spec_output(s) for s in specs])


def _daily_counts(ad_events: DataFrame, key: str, first: dt.date, end: dt.date) -> DataFrame:
    ev = ad_events.filter(F.col("event_date").between(lit_date(first), lit_date(end)))
    return ev.groupBy(key, "event_date").agg(
        F.count_if(IMP()).alias("imps"), F.count_if(CLK()).alias("clicks")
    ).withColumn("rides", F.lit(0).cast("long"))


def backfill_user(
    users, ad_events, rides, start: dt.date, end: dt.date, specs: list[FeatureSpec] | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """W-01 for users: every user and every day in [start, end] in one pass:
    daily (user, day) counts and the users meet in one shuffle by user."""
    specs = specs or [s for s in FEATURE_SPECS if s.entity == "user"]
    max_w = max(s.window_days for s in specs)
    if daily is None:
        ev_daily = _daily_counts(ad_events, "user_id", start - dt.timedelta(days=max_w - 1), end)
        rd = rides.filter(F.col("ride_date").between(lit_date(start - dt.timedelta(days=max_w - 1)), lit_date(end)))
        daily_rides = rd.groupBy("user_id", F.col("ride_date").alias("event_date")).agg(
            F.lit(0).cast("long").alias("imps"), F.lit(0).cast("long").alias("clicks"), F.count("*").alias("rides")
        )
        daily = ev_daily.unionByName(daily_rides)
    out = compose_backfill(daily, "user_id", users.select("user_id", "created_at"), specs, start, end)
    age = account_age_days("created_at", F.col("asof")).alias("user_account_age_days")
    return out.select("user_id", "asof", *[s.name for s in specs], age)


def backfill_ad(ad_events, campaigns, start: dt.date, end: dt.date, specs: list[FeatureSpec] | None = None) -> DataFrame:
    """W-01 for ads: every campaign and every day in [start, end]."""
    specs = specs or [s for s in FEATURE_SPECS if s.entity == "ad"]
    max_w = max(s.window_days for s in specs)
    daily = _daily_counts(ad_events, "campaign_id", start - dt.timedelta(days=max_w - 1), end)
    out = compose_backfill(daily, "campaign_id", campaigns.select("campaign_id", "demand_type", "bid"), specs, start, end)
    return out.select("campaign_id", "asof", *[s.name for s in specs])


def category_counts_by_day(ad_events, start: dt.date, end: dt.date) -> DataFrame:
    """(user_id, category, asof, i, c): 30-day impressions and clicks of every
    day that has any in its window."""
    first = start - dt.timedelta(days=29)
    ev = ad_events.filter(F.col("event_date").between(lit_date(first), lit_date(end)))
    daily = ev.groupBy("user_id", "category", "event_date").agg(
        F.count_if(IMP()).alias("imps"), F.count_if(CLK()).alias("clicks")
    )
    return rolling_days(daily, ["user_id", "category"], {"i": ("imps", 0, 29), "c": ("clicks", 0, 29)}, start, end)


def category_map_by_day(ad_events, start: dt.date, end: dt.date) -> DataFrame:
    """A-06 for every day: (user_id, asof, user_ctr_by_category_30d)."""
    entry = F.struct("category", F.col("c") / F.col("i"))
    return (
        category_counts_by_day(ad_events, start, end)
        .filter(F.col("i") > 0)
        .groupBy("user_id", "asof")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("user_ctr_by_category_30d"))
    )


def rides_by_day(rides, start: dt.date, end: dt.date) -> DataFrame:
    """A-04 for every day: (user_id, asof, user_rides_per_week)."""
    daily = rides.groupBy("user_id", F.col("ride_date").alias("event_date")).agg(F.count("*").alias("rides"))
    x = rolling_days(daily, ["user_id"], {"n": ("rides", 0, 6)}, start, end)
    return x.select("user_id", "asof", F.col("n").cast("double").alias("user_rides_per_week"))


def memberships_backfill(users, ad_events, rides, start: dt.date, end: dt.date, audiences) -> DataFrame:
    """S-08 / A-12 over days: long membership table (user_id, audience,
    definition_version, asof) for every day in [start, end] (no per-day loop)."""
    cat_map, r7 = category_map_by_day(ad_events, start, end), rides_by_day(rides, start, end)
    spine = users.select("user_id", "segment", F.explode(F.sequence(lit_date(start), lit_date(end))).alias("asof"))
    ctx = spine.join(r7, ["user_id", "asof"], "left").join(cat_map, ["user_id", "asof"], "left")
    match = audience_match_cols(audiences)
    versions = {a.name: a.version for a in audiences}
    arr = F.array(
        *[F.when(c, F.struct(F.lit(n).alias("audience"), F.lit(versions[n]).cast("long").alias("definition_version"), F.lit(i).alias("audience_order"))) for i, (n, c) in enumerate(match)]
    )
    return ctx.select("user_id", "asof", F.explode(F.filter(arr, lambda s: s.isNotNull())).alias("m")).select(
        "user_id", "m.audience", "m.definition_version", "asof", "m.audience_order"
    )


def membership_lists(long: DataFrame) -> DataFrame:
    """(user_id, asof, audience_memberships) from the long table; the list
    keeps definition order (bounded by the number of audiences)."""
    return long.groupBy("user_id", "asof").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("audience_order", "audience"))), lambda s: s["audience"]
        ).alias("audience_memberships")
    )


def membership_context(
    users, ad_events, rides, start: dt.date, end: dt.date, audiences, with_inputs: bool = False,
    spine: DataFrame | None = None,
) -> DataFrame:
    """(user_id, asof, segment, audience_memberships) for every user and day
    in [start, end] (empty list, not null): the per-day user context the
    decision job joins once.  ``with_inputs`` also returns the category CTR
    map the rules read (so a snapshot needs no second pass for it).
    ``spine`` (user_id, asof) restricts the context to the pairs a consumer
    needs (e.g. users with requests on the next day) instead of every user
    on every day."""
    cat_map, r7 = category_map_by_day(ad_events, start, end), rides_by_day(rides, start, end)
    if spine is None:
        spine = users.select("user_id", "segment", F.explode(F.sequence(lit_date(start), lit_date(end))).alias("asof"))
    else:
        spine = spine.select("user_id", "asof").join(users.select("user_id", "segment"), "user_id", "left")
    ctx = spine.join(r7, ["user_id", "asof"], "left").join(cat_map, ["user_id", "asof"], "left")
    match = audience_match_cols(audiences)
    arr = F.array(*[F.when(c, F.lit(n)) for n, c in match]) if match else F.array().cast("array<string>")
    extra = ["user_ctr_by_category_30d"] if with_inputs else []
    return ctx.select(
        "user_id", "asof", "segment", F.filter(arr, lambda s: s.isNotNull()).alias("audience_memberships"), *extra
    )
