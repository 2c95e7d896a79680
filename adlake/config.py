"""Configuration as small tables.

FIXED VALUES — these must equal the reference's for results to match:
feature registry, audience definitions, lift rules, thresholds, constants.
They are stated here plainly, in the reference's natural order.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES: feature registry
# (name, entity, dtype, window_days, freshness_sla_seconds, default)
# window_days is None for features without a trailing window.
# --------------------------------------------------------------------------
REGISTRY: list[tuple[str, str, str, int | None, int, object]] = [
    ("user_ctr_by_category_30d", "user", "map[str,float]", 30, 86400, {}),
    ("user_rides_per_week", "user", "float", 7, 86400, 0.0),
    ("user_ctr_30d", "user", "float", 30, 86400, 0.0),
    ("user_impressions_7d", "user", "int", 7, 86400, 0),
    ("ad_ctr_7d", "ad", "float", 7, 86400, 0.0),
    ("ad_ctr_30d", "ad", "float", 30, 86400, 0.0),
    ("ad_impressions_7d", "ad", "int", 7, 86400, 0),
    ("campaign_spend_yesterday", "ad", "float", 1, 86400, 0.0),
    ("audience_memberships", "user", "list[str]", None, 86400, []),
    ("user_account_age_days", "user", "int", None, 86400, 0),
    ("user_session_active", "user", "bool", None, 5, False),
    ("user_current_destination_category", "user", "str", None, 5, ""),
    ("user_current_ride_type", "user", "str", None, 5, ""),
    ("user_screens_viewed_10min", "user", "int", None, 5, 0),
    ("promos_viewed_10min", "user", "int", None, 5, 0),
]
ALLOWED_DTYPES = ("float", "int", "str", "bool", "list[str]", "map[str,float]")

# FIXED VALUES: audiences (name, definition_version, rules as (feature, op, value))
AUDIENCES: list[tuple[str, int, list[tuple[str, str, object]]]] = [
    (
        "frequent_airport_travelers",
        1,
        [("segment", "eq", "traveler"), ("user_ctr_by_category_30d.travel", "gte", 0.05)],
    ),
    (
        "weekday_commuters",
        1,
        [("segment", "eq", "commuter"), ("user_rides_per_week", "gte", 5)],
    ),
]
RULE_OPS = ("eq", "ne", "gt", "gte", "lt", "lte")

# FIXED VALUES: planted lift table (segment, category or '*', condition, multiplier)
SEGMENTS = ["commuter", "traveler", "nightlife", "foodie", "shopper", "homebody", "general"]
CATEGORIES = ["food", "retail", "entertainment", "travel", "transit"]
LIFT_TABLE: list[tuple[str, str, str, float]] = [
    ("commuter", "transit", "any", 3.0),
    ("commuter", "retail", "any", 1.3),
    ("traveler", "travel", "any", 3.0),
    ("traveler", "retail", "any", 1.2),
    ("nightlife", "entertainment", "night", 3.5),
    ("nightlife", "food", "night", 2.5),
    ("nightlife", "entertainment", "day", 1.0),
    ("foodie", "food", "any", 3.0),
    ("shopper", "retail", "any", 3.0),
    ("shopper", "entertainment", "any", 1.2),
    ("homebody", "*", "any", 0.3),
    ("general", "*", "any", 1.0),
]
BASE_CTR = 0.03
MAX_CTR = 0.6
NIGHT_HOURS = [20, 21, 22, 23, 0, 1, 2, 3, 4]

# FIXED VALUES: gates, serving and measurement constants
MIN_ROW_COUNT_RATIO = 0.8
MAX_NULL_RATE = 0.05
Z_95 = 1.959963985
ARM_SALT = "phase5-ab-v1"
ARM_VERSIONS = {"control": "v1", "treatment": "v2"}
DESTINATION_MATCH_BOOST = 1.5
SESSION_TTL_SECONDS = 1800
TRAILING_COUNT_SECONDS = 600
LATENCY_BUCKETS_MS = [1, 2, 5, 10, 20, 50, 100, 250, 500, 1000]
STAGES = ["retrieval", "features", "scoring", "bidder", "total"]
P99_RANK_FRACTION = 0.99
WARMUP_DAYS = 7
HOLDOUT_DAYS = 5
RETRAIN_HOLDOUT_FRACTION = 0.2
KNOWN_EVENT_TYPES = ["session_start", "destination_entered", "ride_type_selected", "app_screen_view", "promo_viewed"]
RIDE_TYPES = ["standard", "shared", "premium"]

# FIXED VALUES: model feature lists
V1_FEATURES = [
    "user_ctr_30d",
    "user_impressions_7d",
    "user_rides_per_week",
    "user_account_age_days",
    "ad_ctr_7d",
    "ad_ctr_30d",
    "ad_impressions_7d",
    "campaign_spend_yesterday",
    "hour_of_day",
    "x_user_ctr_in_ad_category",
]
V2_FEATURES = [
    "user_ctr_30d",
    "user_impressions_7d",
    "user_account_age_days",
    "ad_ctr_7d",
    "ad_impressions_7d",
    "hour_of_day",
    "x_user_ctr_in_ad_category",
]
V3_FEATURES = [*V1_FEATURES, "user_session_active"]

# Feature sets requested per decision (user side / ad side).
SERVE_USER_FEATURES = [
    "user_ctr_30d",
    "user_ctr_by_category_30d",
    "user_impressions_7d",
    "user_rides_per_week",
    "user_account_age_days",
    "audience_memberships",
    "user_current_destination_category",
    "user_session_active",
]
SERVE_AD_FEATURES = ["ad_ctr_7d", "ad_ctr_30d", "ad_impressions_7d", "campaign_spend_yesterday"]

# --------------------------------------------------------------------------
# Driver-table fixture mapping.  The driver tables use TPC-H market segments
# and part types instead of the reference's segment / category words, so the
# config above is translated onto them (data is left untouched).  Unmapped
# words simply never match.
# --------------------------------------------------------------------------
FIXTURE_SEGMENT = {
    "traveler": "AUTOMOBILE",
    "commuter": "BUILDING",
    "nightlife": "FURNITURE",
    "foodie": "HOUSEHOLD",
    "shopper": "MACHINERY",
}
FIXTURE_CATEGORY = {
    "travel": "ECONOMY",
    "transit": "STANDARD",
    "retail": "MEDIUM",
    "food": "PROMO",
    "entertainment": "LARGE",
}
# Share of a request's latency that each stage takes (the events have one number).
FIXTURE_STAGE_SHARE = {"retrieval": 0.125, "features": 0.25, "scoring": 0.375, "bidder": 0.25, "total": 1.0}
FIXTURE_AS_OF = dt.date(2024, 1, 30)
FIXTURE_START = dt.date(2024, 1, 1)
HOUSE_AD_ID = -1  # campaign ids are longs on the driver tables


@dataclass(frozen=True)
class Audience:
    name: str
    version: int
    rules: tuple[tuple[str, str, object], ...]


def fixture_audiences() -> list[Audience]:
    """AUDIENCES with segment / category words mapped onto the driver tables."""
    out = []
    for name, version, rules in AUDIENCES:
        mapped = []
        for feature, op, value in rules:
            if feature == "segment":
                value = FIXTURE_SEGMENT.get(value, value)
            if feature.startswith("user_ctr_by_category_30d."):
                cat = feature.split(".", 1)[1]
                feature = "user_ctr_by_category_30d." + FIXTURE_CATEGORY.get(cat, cat)
            mapped.append((feature, op, value))
        out.append(Audience(name, version, tuple(mapped)))
    return out


def fixture_lift_rules() -> list[tuple[str, str, str, float]]:
    return [
        (FIXTURE_SEGMENT.get(s, s), c if c == "*" else FIXTURE_CATEGORY.get(c, c), cond, m)
        for s, c, cond, m in LIFT_TABLE
    ]


def registry_sql() -> str:
    import json

    vals = ", ".join(
        "('{}', '{}', '{}', {}, {}, '{}')".format(
            n, e, d, "NULL" if w is None else w, s, json.dumps(v).replace("'", "''")
        )
        for n, e, d, w, s, v in REGISTRY
    )
    return (
        "SELECT * FROM (VALUES " + vals + ") AS r(feature_name, entity, dtype, window_days, "
        "freshness_sla_seconds, default_json)"
    )


def lift_rules_df(spark: SparkSession, rules=None) -> DataFrame:
    rules = rules if rules is not None else fixture_lift_rules()
    rows = [(i, s, c, cond, float(m)) for i, (s, c, cond, m) in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_order long, segment string, category string, cond string, multiplier double")


def lift_rules_sql(rules=None) -> str:
    rules = rules if rules is not None else fixture_lift_rules()
    vals = ", ".join(f"({i}, '{s}', '{c}', '{cond}', CAST({m} AS DOUBLE))" for i, (s, c, cond, m) in enumerate(rules))
    return f"SELECT * FROM (VALUES {vals}) AS r(rule_order, segment, category, cond, multiplier)"
