"""Quality gate and governance checks (Q-01 .. Q-04, Q-06).

Every check is one aggregate per frame; a job raises before anything is
written if any check fails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake import config


class QualityGateError(ValueError):
    pass


class ContractError(ValueError):
    pass


def gate_report(df: DataFrame, job: str, feature_cols: list[str], expected: int) -> DataFrame:
    """Q-01 report for one frame, from ONE aggregate: rows, expected, and the
    null count of each feature column, with the pass flags.

    Row gate: rows / expected >= 0.8 (skipped when expected is 0).
    Null gate: null share of every column <= 0.05 (skipped on 0 rows)."""
    agg = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in feature_cols],
    )
    structs = [
        F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("null_count")) for c in feature_cols
    ]
    out = agg.select("rows", F.explode(F.array(*structs)).alias("s")).select(
        F.lit(job).alias("job"),
        F.col("s.feature").alias("feature"),
        F.col("rows"),
        F.lit(expected).cast("long").alias("expected"),
        F.col("s.null_count").alias("null_count"),
    )
    return out.select(
        "*",
        (
            (F.col("expected") == 0)
            | (F.col("rows").cast("double") / F.col("expected") >= F.lit(config.MIN_ROW_COUNT_RATIO))
        ).alias("row_check_passed"),
        (
            (F.col("rows") == 0)
            | (F.col("null_count").cast("double") / F.col("rows") <= F.lit(config.MAX_NULL_RATE))
        ).alias("null_check_passed"),
    )


def enforce(report: DataFrame) -> None:
    """Raise QualityGateError if any row of a gate report failed (one small
    collect of the failing rows; report size = jobs x features)."""
    bad = report.filter(~(F.col("row_check_passed") & F.col("null_check_passed"))).collect()
    if bad:
        r = bad[0]
        raise QualityGateError(
            f"{r['job']}: gate failed on {r['feature']!r} rows={r['rows']} expected={r['expected']} "
            f"nulls={r['null_count']}"
        )


def check_output_contract(df: DataFrame, key: str, outputs: list[str], entity: str) -> None:
    """Q-03 (plan time): columns must be exactly key + declared outputs, and
    every output must be registered for this entity."""
    want = {key, *outputs}
    have = set(df.columns)
    if have != want:
        raise ContractError(f"columns {sorted(have)} != declared {sorted(want)}")
    reg = {n: e for n, e, *_ in config.REGISTRY}
    for o in outputs:
        if o not in reg:
            raise ContractError(f"{o!r} is not a registered feature")
        if reg[o] != entity:
            raise ContractError(f"{o!r} is registered for entity {reg[o]!r}, not {entity!r}")


def contract_violations(df: DataFrame, job: str, key: str, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Q-03 (data): null ids, duplicate ids (non-null ids minus distinct ids)
    and out-of-range values per column, in one aggregate."""
    checks = []
    for c, (lo, hi) in ranges.items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < F.lit(lo))
        if hi is not None:
            cond = cond | (F.col(c) > F.lit(hi))
        checks.append(F.count_if(cond).alias(f"oor_{c}"))
    one = df.agg(
        F.count_if(F.col(key).isNull()).alias("null_ids"),
        (F.count(key) - F.count_distinct(key)).alias("duplicate_ids"),
        *checks,
    )
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"oor_{c}").alias("out_of_range")) for c in ranges]
    return one.select(
        F.lit(job).alias("job"), "null_ids", "duplicate_ids", F.explode(F.array(*structs)).alias("s")
    ).select("job", "s.feature", "null_ids", "duplicate_ids", "s.out_of_range")


def arm_balance(assignments: DataFrame) -> DataFrame:
    """Q-06: share of users per arm and whether control is in [0.4, 0.6]."""
    users = assignments.select("user_id", "experiment_arm").distinct()
    agg = users.agg(
        F.count("*").alias("users"),
        F.count_if(F.col("experiment_arm") == "control").alias("control_users"),
    )
    return agg.select(
        "users",
        "control_users",
        (F.col("control_users") / F.col("users")).alias("control_share"),
        ((F.col("control_users") / F.col("users")).between(0.4, 0.6)).alias("balanced"),
    )
