"""Feature resolution for a table of requests (E-01 .. E-06).

Precedence per (request, feature): real-time session value (users only,
alive = younger than the 1,800 s lifetime at the request time), else the
batch item published for the snapshot before the request day (S-07 long
form), else the registry default.  Status: fresh when age <= SLA, stale
otherwise, missing when the default was substituted.  Never null."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import map_text
from adlake.sources.tables import bounded


def registry_rows() -> list[tuple[str, str, str, int, object]]:
    return [(n, e, d, s, v) for n, e, d, _, s, v in config.REGISTRY]


def publish_daily(user_snap: DataFrame, names: list[str]) -> DataFrame:
    """S-07 for a multi-day user snapshot (user_id, asof, features...): long
    items (user_id, asof, feature_name, value_json, computed_at = asof + 1 day)."""
    vals = user_snap.select(
        "user_id", "asof",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("feature_name"), F.to_json(F.struct(F.col(n).alias("v"))).alias("j"),
                             F.col(n).isNull().alias("is_null"))
                    for n in names
                ]
            )
        ).alias("s"),
    )
    return vals.filter(~F.col("s.is_null")).select(
        "user_id", "asof", F.col("s.feature_name").alias("feature_name"),
        F.expr("substring(s.j, 6, length(s.j) - 6)").alias("value_json"),
        F.to_timestamp(F.date_add("asof", 1)).alias("computed_at"),
    )


def _decode(value_json, dtype_col):
    as_num = value_json.cast("double")
    as_list = F.array_join(F.from_json(value_json, "array<string>"), ",")
    as_str = F.from_json(F.concat(F.lit('{"v":'), value_json, F.lit("}")), "v string")["v"]
    num = F.when(dtype_col == "bool", F.when(value_json == "true", 1.0).otherwise(0.0)).when(
        dtype_col.isin("float", "int"), as_num
    )
    text = F.when(dtype_col == "list[str]", as_list).when(dtype_col == "str", as_str).when(
        dtype_col.startswith("map") | dtype_col.startswith("dict"), value_json
    )
    return num, text


def resolve(
    requests: DataFrame,
    feature_names: list[str],
    realtime: DataFrame,
    published: DataFrame,
) -> DataFrame:
    """E-03 for every (request, requested user feature)."""
    spark = requests.sparkSession
    reg = spark.createDataFrame(
        [(n, e, d, s, json.dumps(v)) for n, e, d, s, v in registry_rows() if n in feature_names],
        "feature_name string, entity string, dtype string, sla long, default_json string",
    )
    reg = bounded(reg)
    rq = requests.select(
        "request_id", "user_id", "ts", F.date_sub(F.to_date("ts"), 1).alias("asof"),
        F.explode(F.array(*[F.lit(n) for n in feature_names])).alias("feature_name"),
    ).join(reg, "feature_name")
    rt = realtime.select("request_id", "feature_name", F.col("value_num").alias("rt_num"),
                         F.col("value_text").alias("rt_text"), F.col("age_seconds").alias("rt_age"))
    b = published.select("user_id", "asof", "feature_name", "value_json", "computed_at")
    j = rq.join(rt, ["request_id", "feature_name"], "left").join(b, ["user_id", "asof", "feature_name"], "left")
    b_num, b_text = _decode(F.col("value_json"), F.col("dtype"))
    d_num, d_text = _decode(F.col("default_json"), F.col("dtype"))
    b_age = (F.unix_micros("ts") - F.unix_micros("computed_at")) / F.lit(1e6)
    has_rt = F.col("rt_age").isNotNull()
    has_b = F.col("value_json").isNotNull()
    age = F.when(has_rt, F.col("rt_age")).when(has_b, b_age)
    status = F.when(~has_rt & ~has_b, F.lit("missing")).when(age <= F.col("sla"), "fresh").otherwise("stale")
    return j.select(
        "request_id",
        "feature_name",
        F.when(has_rt, "realtime").when(has_b, "batch").otherwise("default").alias("source"),
        status.alias("freshness_status"),
        (~has_rt & ~has_b).alias("default_substituted"),
        F.when(has_rt, F.col("rt_num")).when(has_b, b_num).otherwise(d_num).alias("value_num"),
        F.when(has_rt, F.col("rt_text")).when(has_b, b_text).otherwise(d_text).alias("value_text"),
    )


def invalid_requests(feature_requests: DataFrame) -> DataFrame:
    """E-04: (request_id, entity, feature_name) rows whose feature is not
    registered, or registered for another entity.  Anti/left join with the
    size-checked registry."""
    spark = feature_requests.sparkSession
    reg = bounded(spark.createDataFrame([(n, e) for n, e, *_ in registry_rows()], "feature_name string, reg_entity string"))
    j = feature_requests.join(reg, "feature_name", "left")
    return j.filter(F.col("reg_entity").isNull() | (F.col("reg_entity") != F.col("entity"))).select(
        "request_id", "entity", "feature_name",
        F.when(F.col("reg_entity").isNull(), "unregistered").otherwise("wrong_entity").alias("reason"),
    )


def deterministic_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """K-04: n rows chosen by a hash order of the key (a top-k, not a sort)."""
    return df.orderBy(F.sha2(F.col(key).cast("string"), 256)).limit(n)


def parity(offline: DataFrame, online: DataFrame, key: list[str], tol: float = 1e-6) -> DataFrame:
    """E-06: full join of two long frames (key..., feature_name, value) and a
    per-feature count of compared and differing cells."""
    o = offline.withColumnRenamed("value", "off")
    n = online.withColumnRenamed("value", "on")
    j = o.join(n, [*key, "feature_name"], "full")
    diff = ~(
        (F.col("off").isNull() & F.col("on").isNull()) | (F.abs(F.col("off") - F.col("on")) <= F.lit(tol))
    )
    return j.groupBy("feature_name").agg(F.count("*").alias("compared"), F.count_if(F.coalesce(diff, F.lit(True))).alias("differing"))



def _value_cols(name: str, dtype: str, col) -> tuple:
    """(value_num, value_text) of a typed column."""
    if dtype in ("float", "int"):
        return col.cast("double"), F.lit(None).cast("string")
    if dtype == "bool":
        return F.when(col, 1.0).otherwise(0.0), F.lit(None).cast("string")
    if dtype == "str":
        return F.lit(None).cast("double"), col.cast("string")
    if dtype == "list[str]":
        return F.lit(None).cast("double"), F.array_join(col, ",")
    return F.lit(None).cast("double"), map_text(col)


class ResolverError(ValueError):
    pass


def validate(entity: str, feature_names: list[str]) -> None:
    """E-04: a query with an unregistered feature, or one of another entity,
    fails as a whole before anything is resolved."""
    reg = {n: e for n, e, *_ in registry_rows()}
    for n in feature_names:
        if n not in reg:
            raise ResolverError(f"{n!r} is not a registered feature")
        if reg[n] != entity:
            raise ResolverError(f"{n!r} is registered as entity {reg[n]!r}, not {entity!r}")


def resolve_entity(requests: DataFrame, entity: str, feature_names: list[str], snapshot: DataFrame, session_events: DataFrame | None = None) -> DataFrame:
    """E-03 in its scale form: each request meets each store once.

    ``requests`` (request_id, the entity's id, ts).  Session values (users)
    come from one as-of window over all session features; the batch side is one
    equi-join with the wide daily snapshot of the previous day on (id, asof).
    Precedence real-time > batch > default and the status are column
    expressions, unpivoted at the end (one output row per feature)."""
    from adlake.operators.session_features import SESSION_FEATURES, session_values_at
    from adlake.sources.snapshots import ENTITY_KEY

    validate(entity, feature_names)
    key = ENTITY_KEY[entity]
    reg = {n: (d, s, v) for n, _, d, s, v in registry_rows()}
    live = [n for n in feature_names if n in SESSION_FEATURES and entity == "user"]
    batch = [n for n in feature_names if n in snapshot.columns]
    r = requests.select("request_id", key, "ts")
    if live:
        r = session_values_at(r, session_events)
    snap = snapshot.select(key, "asof", *(F.col(n).alias(f"b_{n}") for n in batch))
    r = r.withColumn("asof", F.date_sub(F.to_date("ts"), 1)).join(snap, [key, "asof"], "left")
    b_age = (F.unix_micros("ts") - F.unix_micros(F.to_timestamp(F.date_add("asof", 1)))) / F.lit(1e6)
    none = (F.lit(None).cast("double"), F.lit(None).cast("string"))
    rows = []
    for n in feature_names:
        dtype, sla, default = reg[n]
        has_rt = F.col(n).isNotNull() if n in live else F.lit(False)
        has_b = F.col(f"b_{n}").isNotNull() if n in batch else F.lit(False)
        rt_num, rt_text = _value_cols(n, dtype, F.col(n)["value"]) if n in live else none
        b_num, b_text = _value_cols(n, dtype, F.col(f"b_{n}")) if n in batch else none
        d_num, d_text = _decode(F.lit(json.dumps(default)), F.lit(dtype))
        age = F.when(has_rt, F.col(n)["age_seconds"] if n in live else none[0]).when(has_b, b_age)
        status = F.when(~has_rt & ~has_b, F.lit("missing")).when(age <= F.lit(sla), "fresh").otherwise("stale")
        rows.append(
            F.struct(
                F.lit(n).alias("feature_name"),
                F.when(has_rt, "realtime").when(has_b, "batch").otherwise("default").alias("source"),
                status.alias("freshness_status"),
                (~has_rt & ~has_b).alias("default_substituted"),
                F.when(has_rt, rt_num).when(has_b, b_num).otherwise(d_num).cast("double").alias("value_num"),
                F.when(has_rt, rt_text).when(has_b, b_text).otherwise(d_text).cast("string").alias("value_text"),
            )
        )
    return r.select("request_id", F.lit(entity).alias("entity"), F.explode(F.array(*rows)).alias("x")).select("request_id", "entity", "x.*")
