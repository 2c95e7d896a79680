"""Column -> Column helpers (F-01 .. F-17).  All JVM-side built-ins."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake import config


def lit_date(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def in_window(date_col: Column | str, as_of: dt.date, window_days: int) -> Column:
    """P-01: date in [as_of - W + 1, as_of]."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return c.between(lit_date(as_of - dt.timedelta(days=window_days - 1)), lit_date(as_of))


def account_age_days(created_at: Column | str, as_of: Column | dt.date) -> Column:
    """P-10 / F-01: days from created_at to as_of (negative if created later)."""
    a = as_of if isinstance(as_of, Column) else lit_date(as_of)
    c = F.col(created_at) if isinstance(created_at, str) else created_at
    return F.datediff(a, c).cast("long")


def day_part(hour: Column) -> Column:
    """F-03: 'night' for hours 20..23 and 0..4, else 'day'."""
    return F.when(hour.isin(*config.NIGHT_HOURS), "night").otherwise("day")


def map_lookup_default(m: Column, key: Column, default: float = 0.0) -> Column:
    """F-04: x_user_ctr_in_ad_category = coalesce(map[cat], 0.0)."""
    return F.coalesce(F.try_element_at(m, key), F.lit(default)).cast("double")


def assign_arm(user_id: Column, salt: str = config.ARM_SALT) -> Column:
    """F-06: sha256('salt:user') as an integer, mod 2 -> control / treatment.

    An integer's parity is the parity of its last hex digit."""
    digest = F.sha2(F.concat(F.lit(salt + ":"), user_id.cast("string")), 256)
    last = F.conv(F.substring(digest, -1, 1), 16, 10).cast("int")
    return F.when(last % 2 == 0, "control").otherwise("treatment")


def flight_fraction(now: Column, start: Column, end: Column) -> Column:
    """F-07: elapsed share of the flight, clamped to [0, 1]; 1.0 if length <= 0."""
    total = F.datediff(end, start)
    elapsed = F.datediff(now, start)
    return F.when(total <= 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), elapsed.cast("double") / total.cast("double")))
    )


def behind_schedule(delivered: Column, goal: Column, fraction: Column) -> Column:
    """F-08: delivered < goal * fraction (strict)."""
    return delivered.cast("double") < goal.cast("double") * fraction


def boosted_pctr(pctr: Column, destination: Column, category: Column) -> Column:
    """F-09: pctr * 1.5 capped at 1 when the user's current destination equals
    the ad category."""
    match = destination.isNotNull() & (destination != "") & (destination == category)
    return F.when(match, F.least(F.lit(1.0), pctr * config.DESTINATION_MATCH_BOOST)).otherwise(pctr)


def ecpm(bid: Column, pctr: Column) -> Column:
    """F-09: bid * pctr, null without a bid."""
    return F.when(bid.isNotNull(), bid * pctr)


def wilson_bounds(clicks: Column, n: Column, z: float = config.Z_95) -> tuple[Column, Column]:
    """F-10: Wilson score interval; (0, 0) when n = 0."""
    nd = n.cast("double")
    p = clicks.cast("double") / nd
    z2 = z * z
    denom = F.lit(1.0) + F.lit(z2) / nd
    center = p + F.lit(z2) / (F.lit(2.0) * nd)
    margin = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / nd + F.lit(z2) / (F.lit(4.0) * nd * nd))
    lo = F.when(n == 0, F.lit(0.0)).otherwise((center - margin) / denom)
    hi = F.when(n == 0, F.lit(0.0)).otherwise((center + margin) / denom)
    return lo, hi


def click_probability(lift: Column) -> Column:
    """F-12: min(0.03 * lift, 0.6)."""
    return F.least(F.lit(config.BASE_CTR) * lift, F.lit(config.MAX_CTR))


def freshness_status(age_seconds: Column, sla_seconds: Column) -> Column:
    """F-13."""
    return F.when(age_seconds <= sla_seconds, "fresh").otherwise("stale")


def rule_predicate(col: Column, op: str, value) -> Column:
    """P-06: one audience rule as a Column."""
    v = F.lit(value)
    return {
        "eq": lambda: col == v,
        "ne": lambda: col != v,
        "gt": lambda: col > v,
        "gte": lambda: col >= v,
        "lt": lambda: col < v,
        "lte": lambda: col <= v,
    }[op]()


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def map_text(col: Column) -> Column:
    """A map of numbers as JSON text: sorted keys, six digits."""
    entry = F.transform(F.array_sort(F.map_entries(col)), lambda e: F.format_string('"%s":%.6f', e["key"], e["value"]))
    return F.concat(F.lit("{"), F.array_join(entry, ","), F.lit("}"))


def campaign_label(campaign_id: Column, advertiser: Column, category: Column) -> Column:
    """F-17: 'id (category, advertiser)'; the bare id when the campaign is
    unknown; '(none)' for a null id."""
    cid = campaign_id.cast("string")
    return (
        F.when(campaign_id.isNull(), F.lit("(none)"))
        .when(category.isNull() & advertiser.isNull(), cid)
        .otherwise(F.format_string("%s (%s, %s)", cid, category, advertiser))
    )


def rate_from_counter(prev: Column, curr: Column, elapsed_s: Column) -> Column:
    """W-07: max(0, delta) / elapsed; 0 when elapsed <= 0."""
    return F.when(elapsed_s <= 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), (curr - prev).cast("double")) / elapsed_s.cast("double")
    )
