"""Ranks by range: running sums, quantiles, plans without a global window."""

import random

import numpy as np
from pyspark.sql import functions as F

from adlake.operators import ranks as rk


def test_sums_before_with_groups_and_negative_values(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(-5, 9)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v long, n long").repartition(5)
    got = {(r.g, r.v): r.before for r in rk.with_sums_before(df, ["g"], ["v"], {"before": "n"}).collect()}
    total = {}
    for g, v, n in sorted(rows, key=lambda r: r[1]):
        assert got[g, v] == total.get(g, 0)
        total[g] = total.get(g, 0) + n


def test_row_numbers_are_a_total_order(spark):
    df = spark.createDataFrame([(x % 7, x) for x in range(300)], "k long, id long")
    got = [(r.k, r.id) for r in rk.row_numbers(df, ["k", "id"], "row").orderBy("row").collect()]
    assert got == sorted((x % 7, x) for x in range(300))
    assert rk.row_numbers(df.limit(0), ["k", "id"], "row").collect() == []


def test_quantiles_equal_numpy(spark):
    rng = random.Random(4)
    for values in ([rng.choice([0.0, 0.5, 1.0, rng.random()]) for _ in range(777)], [2.5], [1.0, 4.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        probs = [0.1, 0.25, 0.5, 0.9, 1.0]
        assert np.allclose(rk.quantiles(df, "v", probs), np.quantile(values, probs), rtol=1e-12)
    assert rk.quantiles(df.limit(0), "v", [0.5]) == []


def test_no_window_over_a_whole_stage(spark):
    """The latency report orders values inside parts of a range; the one other
    window runs over a row per part."""
    from adlake.operators import reports as rp

    lat = spark.range(1000).select(F.col("id").alias("request_id"), F.lit("total").alias("stage"), (F.col("id") % 97 / 7.0).alias("latency_ms"))
    plan = rp.stage_latency_p99(lat)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if line.strip(" +-:").startswith("Window ")]
    assert len(windows) == 2 and all("__part" in w for w in windows)
