"""Views of the ad domain over the driver's Parquet tables (S-01).

Every view is a lazy DataFrame: Catalyst prunes columns and pushes the
filters of the consuming query down to the Parquet scan.  The matching
DuckDB definitions live in :mod:`adlake.plans.sql_views`.

Mapping (see FIXTURES.md part B):
  users          customer + nation + first order date
  campaigns      part
  ad_events      events of type view (impression) / click
  rides          events of type purchase
  session_events all events, renamed to the session-event vocabulary
  requests       events of type view
  external_bids  request_id, bid (every third request bids)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake import config

# Small config / catalog tables are broadcast only after their size is checked.
BROADCAST_ROW_LIMIT = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table as a lazy DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> bool:
    """True if ``df`` has at most ``max_rows`` rows now (a limit + count job)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``max_rows`` rows;
    otherwise leave the join strategy to the planner (sort-merge / AQE)."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def event_ts(col: str = "ts") -> Column:
    """events.ts is TIMESTAMP_NTZ; event-time operators need TIMESTAMP (UTC)."""
    return F.col(col).cast("timestamp")


def prop_k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    auction = key % 2 == 0
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    start = F.date_add(F.lit(config.FIXTURE_START), (key % 25 - 5).cast("int"))
    end = F.date_add(start, (10 + key % 30).cast("int"))
    return p.select(
        key.alias("campaign_id"),
        F.col("p_brand").alias("advertiser_name"),
        F.col("p_type").alias("category"),
        F.when(auction, "auction").otherwise("guaranteed").alias("demand_type"),
        # round(price / 1000, 2) half-up, done on integer cents to stay exact
        F.when(auction, ((cents + 500) / 1000).cast("long") / 100.0).alias("bid"),
        F.when(auction, F.col("p_size") * 10.0).alias("budget"),
        F.when(~auction, (F.col("p_size") * 2).cast("long")).alias("impression_goal"),
        start.alias("flight_start"),
        end.alias("flight_end"),
        F.when(end < F.lit(config.FIXTURE_AS_OF), "ended")
        .when(key % 8 == 0, "paused")
        .otherwise("active")
        .alias("status"),
        F.when(key == 21, F.array(F.lit("frequent_airport_travelers")))
        .when(key == 22, F.array(F.lit("weekday_commuters")))
        .otherwise(F.array().cast("array<string>"))
        .alias("targeted_audiences"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    first_order = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(F.to_date("o_orderdate")).alias("created_at"))
    )
    return (
        c.join(bounded(n.select("n_nationkey", "n_name")), c.c_nationkey == n.n_nationkey, "left")
        .join(first_order, c.c_custkey == first_order.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("home_metro"),
            F.col("created_at"),
        )
    )


def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )


def ad_events(spark: SparkSession, sf_dir: str, with_category: bool = True) -> DataFrame:
    e = read(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    out = e.select(
        F.col("event_id"),
        F.when(F.col("event_type") == "view", "impression").otherwise("click").alias("event_type"),
        F.col("user_id"),
        prop_k().alias("campaign_id"),
        event_ts().alias("ts"),
        F.to_date(event_ts()).alias("event_date"),
        F.hour(event_ts()).cast("long").alias("hour_of_day"),
    )
    if with_category:
        # The catalog grows with its table: the planner picks the join by its size.
        out = out.join(campaigns(spark, sf_dir).select("campaign_id", "category"), "campaign_id", "left")
    return out


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    types = F.array(*[F.lit(t) for t in config.RIDE_TYPES])
    return e.select(
        F.col("event_id").alias("ride_id"),
        F.col("user_id"),
        event_ts().alias("ts"),
        F.to_date(event_ts()).alias("ride_date"),
        F.element_at(types, (prop_k() % 3 + 1).cast("int")).alias("ride_type"),
    )


SESSION_TYPE = {
    "signup": "session_start",
    "click": "destination_entered",
    "purchase": "ride_type_selected",
    "view": "app_screen_view",
}


def session_type_col() -> Column:
    c = F.col("event_type")
    expr = None
    for src, dst in SESSION_TYPE.items():
        expr = F.when(c == src, dst) if expr is None else expr.when(c == src, dst)
    return expr.otherwise(c)


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as session events; `error` keeps its name and plays the
    unknown type.  payload: category for destinations, ride_type for rides."""
    e = read(spark, sf_dir, "events")
    cats = campaigns(spark, sf_dir).select(F.col("campaign_id").alias("k"), "category")
    types = F.array(*[F.lit(t) for t in config.RIDE_TYPES])
    base = e.select(
        "event_id",
        session_type_col().alias("event_type"),
        "user_id",
        event_ts().alias("ts"),
        prop_k().alias("k"),
    ).join(cats, "k", "left")
    return base.select(
        "event_id",
        "event_type",
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        "ts",
        F.when(F.col("event_type") == "destination_entered", F.create_map(F.lit("category"), F.col("category")))
        .when(
            F.col("event_type") == "ride_type_selected",
            F.create_map(F.lit("ride_type"), F.element_at(types, (F.col("k") % 3 + 1).cast("int"))),
        )
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("payload"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(
        F.col("event_id").alias("request_id"),
        "user_id",
        event_ts().alias("ts"),
        F.to_date(event_ts()).alias("request_date"),
        F.hour(event_ts()).cast("long").alias("hour_of_day"),
    )


def requests_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """requests + external bid + dependency health, all columns of the same
    request event (one scan, no joins)."""
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    v = F.col("value")
    return e.select(
        F.col("event_id").alias("request_id"),
        "user_id",
        event_ts().alias("ts"),
        F.to_date(event_ts()).alias("request_date"),
        F.hour(event_ts()).cast("long").alias("hour_of_day"),
        F.when(F.col("event_id") % 3 == 0, v / 100.0).alias("external_bid"),
        (~((v >= 2) & (v < 3))).alias("model_ok"),
        (~(v < 1)).alias("features_ok"),
        (~((v >= 1) & (v < 2))).alias("pacing_ok"),
        stage_latencies(v).alias("stage_latencies_ms"),
    )


def stage_latencies(total: Column) -> Column:
    """Latency of each stage: fixed shares of the request's value (ms)."""
    return F.create_map(*[x for stage, share in config.FIXTURE_STAGE_SHARE.items() for x in (F.lit(stage), total * share)])


def request_latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-request latency samples of all stages."""
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(
        F.col("event_id").alias("request_id"), event_ts().alias("ts"), F.explode(stage_latencies(F.col("value"))).alias("stage", "latency_ms")
    )


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-request dependency health (fixture mapping of the request value):
    < 1 feature service down, [1, 2) pacing store down, [2, 3) model down."""
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    v = F.col("value")
    return e.select(
        F.col("event_id").alias("request_id"),
        (~((v >= 2) & (v < 3))).alias("model_ok"),
        (~(v < 1)).alias("features_ok"),
        (~((v >= 1) & (v < 2))).alias("pacing_ok"),
    )


def external_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("event_id") % 3 == 0, F.col("value") / 100.0).alias("bid"),
    )


def user_daily_activity(spark: SparkSession, sf_dir: str, first: dt.date, end: dt.date) -> DataFrame:
    """(user_id, event_date, imps, clicks, rides) from ONE scan of the event
    table (impressions = views, rides = purchases), partially aggregated
    before the shuffle.  Feeds the user backfill without a second scan."""
    e = read(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click", "purchase"))
    d = F.to_date(event_ts())
    e = e.filter(d.between(F.lit(first), F.lit(end)))
    t = F.col("event_type")
    return e.groupBy("user_id", d.alias("event_date")).agg(
        F.count_if(t == "view").alias("imps"), F.count_if(t == "click").alias("clicks"), F.count_if(t == "purchase").alias("rides")
    )


def window_bounds(as_of: dt.date, window_days: int) -> tuple[dt.date, dt.date]:
    """Trailing W-day window [as_of - W + 1, as_of], both ends included."""
    return as_of - dt.timedelta(days=window_days - 1), as_of
