"""Ranks and quantiles of whole tables without a task that holds them all.

Rows are split by range of the ordering columns, as many parts as the session
has shuffle partitions.  A part's sums give every part its offset (a row per
part and group), and a window inside each part does the rest.  Rows of equal
order lie in one part."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.session import materialize


def with_sums_before(df: DataFrame, group: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds for each ``name: column`` the sum of the column over the rows of
    the group that come before in ``order`` (ascending; unique in a group)."""
    parts = materialize(df.repartitionByRange(*group, *order).withColumn("__part", F.spark_partition_id()))
    totals = parts.groupBy("__part", *group).agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    # A row per part and group: as many as the shuffle has partitions, and the groups.
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", *group, *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in sums))
    p, o = parts.alias("p"), offsets.alias("o")
    same = F.col("p.__part") == F.col("o.__part")
    for g in group:
        same = same & F.col(f"p.{g}").eqNullSafe(F.col(f"o.{g}"))
    inside = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    j = p.join(o, same).select("p.*", *(f"o.__{n}" for n in sums))
    return j.select(
        *df.columns, *((F.col(f"__{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items())
    )


def row_numbers(df: DataFrame, order: list[str], out: str, group: list[str] | None = None) -> DataFrame:
    """Row numbers from 1 in a total order."""
    one = df.withColumn("__one", F.lit(1).cast("long"))
    ranked = with_sums_before(one, group or [], order, {out: "__one"})
    return ranked.drop("__one").withColumn(out, F.col(out) + 1)


def value_counts(df: DataFrame, group: list[str], col: str) -> DataFrame:
    """Distinct values (nulls left out) with their count and the counts before."""
    v = df.where(F.col(col).isNotNull()).groupBy(*group, F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return with_sums_before(v, group, ["value"], {"before": "n"})


def quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float]:
    """Exact quantiles with linear interpolation between neighbours."""
    v = materialize(value_counts(df, [], col))
    total = v.agg(F.sum("n")).first()[0]
    if not total:
        return []
    places = {p: divmod((total - 1) * p, 1) for p in probs}
    ranks = sorted({r for lo, _ in places.values() for r in (int(lo), min(int(lo) + 1, total - 1))})
    asked = F.explode(F.filter(F.array(*map(F.lit, ranks)), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))))
    at = {r["rank"]: r["value"] for r in v.select("value", asked.alias("rank")).collect()}  # two values for each quantile
    out = []
    for lo, share in places.values():
        a, b = at[int(lo)], at[min(int(lo) + 1, total - 1)]
        out.append(a + (b - a) * share)
    return out
