"""Reports over the decision log (R-01 .. R-05, A-16 .. A-20, W-06, W-07,
K-03, K-05, J-08, J-09, P-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import campaign_label, rate_from_counter, wilson_bounds
from adlake.operators.asof import attribute_clicks
from adlake.operators.ranks import row_numbers, value_counts


def real_impressions(decisions: DataFrame) -> DataFrame:
    """P-09: decisions that served a real campaign (not none, not house ad)."""
    return decisions.filter(F.col("winner").isNotNull() & (F.col("winner") != F.lit(config.HOUSE_AD_ID)))


def touched_campaigns(decisions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaigns whose capacity counter was read: live on the day of a request
    that reached retrieval.  Days are few, so this is a small join."""
    days = decisions.filter(F.col("fallback_rung").isNull()).select(F.col("request_date").alias("day")).distinct()
    flight = F.explode(F.sequence("flight_start", "flight_end"))
    live = campaigns.filter((F.col("status") == "active") & (F.col("flight_start") <= F.col("flight_end"))).select("campaign_id", flight.alias("day"))
    return live.join(days, "day", "left_semi").select("campaign_id").distinct()


def reconcile(decisions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """R-01: per campaign initial, remaining (initial - decremented wins),
    expected consumed, actual served (all wins, any rung) and discrepancy;
    untouched and unserved campaigns omitted; K-03 rank by |discrepancy|."""
    wins = F.count_if(F.col("rung").isin("guaranteed", "auction"))
    served = decisions.filter(F.col("winner").isNotNull()).groupBy(F.col("winner").alias("campaign_id")).agg(
        F.count("*").alias("actual_served"), F.nullif(wins, F.lit(0)).alias("dec")
    )
    touched = touched_campaigns(decisions, campaigns).withColumn("touched", F.lit(True))
    initial = F.when(F.col("demand_type") == "guaranteed", F.col("impression_goal").cast("double")).otherwise(
        F.col("budget")
    )
    j = (
        campaigns.select("campaign_id", "demand_type", initial.alias("initial_capacity"))
        .join(served, "campaign_id", "left")
        .join(touched, "campaign_id", "left")
    )
    j = j.filter(F.col("touched").isNotNull() | F.col("dec").isNotNull() | (F.coalesce("actual_served", F.lit(0)) > 0))
    remaining = F.col("initial_capacity") - F.coalesce("dec", F.lit(0))
    out = j.select(
        "campaign_id",
        "demand_type",
        "initial_capacity",
        remaining.alias("remaining_capacity"),
        (F.col("initial_capacity") - remaining).alias("expected_consumed"),
        F.coalesce("actual_served", F.lit(0)).cast("long").alias("actual_served"),
    ).withColumn("discrepancy", F.col("expected_consumed") - F.col("actual_served"))
    out = out.withColumn("size", -F.abs("discrepancy"))
    return row_numbers(out, ["size", "campaign_id"], "discrepancy_rank").drop("size")


def decision_clicks(decisions: DataFrame, ad_events: DataFrame) -> DataFrame:
    """Real-click labels for served decisions: every click event is
    attributed (as of its time) to the latest decision that served that
    campaign to that user; a decision is clicked if any click points to it."""
    served = real_impressions(decisions).select(
        "user_id", F.col("winner").alias("campaign_id"), F.col("request_id").alias("event_id"), "ts",
        F.lit("impression").alias("event_type"),
    )
    clicks = ad_events.filter(F.col("event_type") == "click").select(
        "user_id", "campaign_id", "event_id", "ts", "event_type"
    )
    att = attribute_clicks(served.unionByName(clicks))
    return att.filter(F.col("impression_id").isNotNull()).select(F.col("impression_id").alias("request_id")).distinct()


def experiment_readout(decisions: DataFrame, ad_events: DataFrame) -> DataFrame:
    """R-02: per arm impressions (real wins), clicks (real click join), CTR,
    95 % Wilson interval, and whether the arms' intervals overlap."""
    imps = real_impressions(decisions).select("request_id", "experiment_arm")
    clicked = decision_clicks(decisions, ad_events).withColumn("clicked", F.lit(1))
    per = imps.join(clicked, "request_id", "left").groupBy("experiment_arm").agg(
        F.count("*").alias("impressions"), F.count("clicked").alias("clicks")
    )
    lo, hi = wilson_bounds(F.col("clicks"), F.col("impressions"))
    per = per.select(
        "experiment_arm", "impressions", "clicks",
        F.when(F.col("impressions") > 0, F.col("clicks") / F.col("impressions")).otherwise(0.0).alias("ctr"),
        lo.alias("ci_low"), hi.alias("ci_high"),
    )
    # Two intervals overlap iff max(low) <= min(high); the readout has one
    # row per arm, so this window over it is tiny.
    w = Window.partitionBy(F.lit(1))
    return per.select("*", (F.max("ci_low").over(w) <= F.min("ci_high").over(w)).alias("cis_overlap"))


def fallback_rung_counts(decisions: DataFrame) -> DataFrame:
    """A-18."""
    return decisions.filter(F.col("fallback_rung").isNotNull()).groupBy("fallback_rung").agg(
        F.count("*").alias("requests")
    )


def stage_latency_p99(latencies: DataFrame) -> DataFrame:
    """W-06: nearest-rank p99 = sorted[int(n * 0.99)] and mean over all
    samples per stage: the value whose rank range holds that place."""
    v = value_counts(latencies, ["stage"], "latency_ms")
    n = latencies.groupBy("stage").agg(F.count("latency_ms").alias("n"), F.avg("latency_ms").alias("latency_ms_avg"))
    place = F.floor(F.col("total") * F.lit(config.P99_RANK_FRACTION))
    j = v.join(n.withColumnRenamed("n", "total"), "stage").filter((F.col("before") <= place) & (place < F.col("before") + F.col("n")))
    return j.select("stage", F.col("total").alias("n"), F.col("value").alias("latency_ms_p99"), "latency_ms_avg")


def latency_histogram(latencies: DataFrame) -> DataFrame:
    """A-20: cumulative count of samples <= each bound, per stage: one
    aggregate with one conditional count per bound (no join to bounds)."""
    aggs = [F.count_if(F.col("latency_ms") <= b).alias(f"le_{b}") for b in config.LATENCY_BUCKETS_MS]
    a = latencies.groupBy("stage").agg(*aggs)
    st = F.array(
        *[F.struct(F.lit(b).cast("long").alias("bound_ms"), F.col(f"le_{b}").alias("count")) for b in config.LATENCY_BUCKETS_MS]
    )
    return a.select("stage", F.explode(st).alias("s")).select("stage", "s.bound_ms", "s.count")


def counter_rate(decisions: DataFrame, poll_seconds: int = 3600) -> DataFrame:
    """W-07: the decision counter polled every `poll_seconds`; rate between
    consecutive polls = max(0, delta) / elapsed.  The series has one row per
    poll (time range / interval), so its ordered window is small."""
    poll = F.timestamp_seconds(
        (F.floor(F.unix_seconds("ts") / poll_seconds) + 1) * poll_seconds
    )  # counter value as seen at the end of the interval
    counts = decisions.groupBy(poll.alias("poll_ts")).agg(F.count("*").alias("n"))
    rng = counts.agg(F.min("poll_ts").alias("a"), F.max("poll_ts").alias("b"))
    spine = rng.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {poll_seconds} SECONDS"))).alias("poll_ts"))
    s = spine.join(counts, "poll_ts", "left").fillna(0, ["n"])
    w = Window.partitionBy(F.lit(1)).orderBy("poll_ts")
    s = s.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("prev", F.lag("cum").over(w)).withColumn("prev_ts", F.lag("poll_ts").over(w))
    elapsed = F.unix_seconds("poll_ts") - F.unix_seconds("prev_ts")
    return s.filter(F.col("prev").isNotNull()).select(
        F.col("poll_ts").cast("timestamp_ntz").alias("poll_ts"),
        F.col("cum").alias("requests_total"),
        rate_from_counter(F.col("prev"), F.col("cum"), elapsed).alias("requests_per_sec"),
    )


def latest_per_request(decisions: DataFrame) -> DataFrame:
    """K-05: the most recent log entry per request id."""
    return decisions.groupBy("request_id").agg(
        F.max_by(F.struct("winner", "rung", "ts"), F.struct("ts", "winner")).alias("d")
    ).select("request_id", "d.winner", "d.rung")


def enriched(decisions: DataFrame, segments: DataFrame, campaigns: DataFrame) -> DataFrame:
    """J-08: user segment and winner category / advertiser; unknown -> null."""
    c = campaigns.select(F.col("campaign_id").alias("winner"), "category", "advertiser_name")
    return decisions.join(segments, "user_id", "left").join(c, "winner", "left").select(
        "request_id", "user_id", "segment", "winner", "category", "advertiser_name"
    )


def winner_features(decisions: DataFrame) -> DataFrame:
    """J-09: the scored entry of the winner with its logged features;
    decisions without one dropped."""
    m = F.filter("scores", lambda s: s["campaign_id"] == F.col("winner"))
    return (
        decisions.select("request_id", "winner", F.get(m, 0).alias("w"))
        .filter(F.col("w").isNotNull())
        .select(
            "request_id", "winner", F.col("w.category").alias("category"), F.col("w.pctr").alias("pctr"),
            F.col("w.ecpm").alias("ecpm"), F.col("w.features").alias("features"),
        )
    )


def decision_trail(decisions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """R-05: every scored group of every decision (its best campaign and how
    many it stands for) with label and score, whether it won, the decision's
    rung, external bid and total latency."""
    x = decisions.select(
        "request_id", "winner", "rung", "external_bid", F.col("stage_latencies_ms")["total"].alias("total_ms"),
        F.explode("scores").alias("s"),
    ).select("request_id", "winner", "rung", "external_bid", "total_ms", "s.campaign_id", "s.campaigns", "s.pctr", "s.ecpm")
    c = campaigns.select("campaign_id", "category", "advertiser_name")
    return x.join(c, "campaign_id", "left").select(
        "request_id", "campaign_id", "campaigns",
        campaign_label(F.col("campaign_id"), F.col("advertiser_name"), F.col("category")).alias("label"),
        "pctr", "ecpm", (F.col("campaign_id") == F.col("winner")).alias("is_winner"), "rung", "external_bid", "total_ms",
    )


def spend_delivery_view(recon: DataFrame, campaigns: DataFrame) -> DataFrame:
    """R-04: reconciliation with labels, numbers rounded to one digit."""
    c = campaigns.select("campaign_id", "category", "advertiser_name")
    j = recon.join(c, "campaign_id", "left")
    return j.select(
        "campaign_id",
        campaign_label(F.col("campaign_id"), F.col("advertiser_name"), F.col("category")).alias("label"),
        "demand_type",
        F.round("initial_capacity", 1).alias("initial"),
        F.round("remaining_capacity", 1).alias("remaining"),
        F.round("expected_consumed", 1).alias("consumed"),
        "actual_served",
        F.round("discrepancy", 1).alias("discrepancy"),
    )
