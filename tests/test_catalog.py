"""Driver contract, SQL-oracle agreement on the small tables, and plan
shape checks (pushdown, pruning, no unplanned nested-loop joins)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001  # noqa: E402
from oracle_check import compare, duck  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:2] == ["user_id", "as_of_date"]


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 110


ORACLE_SAMPLE = [
    "user_ctr_30d",
    "feature_backfill_user",
    "audience_memberships",
    "audience_overlap",
    "ctr_cube",
    "screens_viewed_10min_batch",
    "attribute_clicks_asof",
    "pit_training_rows",
    "decide_with_fallback",
    "reconcile_delivery",
    "resolve_features",
    "stage_latency_p99",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_oracle_agreement_sf0001(spark, con, key):
    ok, msg = compare(spark, con, key, SF001)
    assert ok, msg


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filters_and_columns_reach_the_scan(spark):
    """The event-type filter and the date window (rewritten to a ts range on
    the raw column) are pushed into the Parquet scan; only 3 columns are read."""
    plan = _formatted(E.queries()["user_ctr_30d"](spark, SF001))
    pushed = [line for line in plan.split("\n") if line.startswith("PushedFilters")][0]
    assert "In(event_type, [click,view])" in pushed
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
    schema = [line for line in plan.split("\n") if line.startswith("ReadSchema")][0]
    assert schema == "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"


def test_decision_plan_has_no_unplanned_nested_loop(spark):
    from adlake.plans import q_decisions as qd

    res = qd.run_decisions(spark, SF001)
    for name in ("eligible", "scored", "arbitrated"):
        plan = _plan(res[name])
        assert "CartesianProduct" not in plan
        # the only theta join allowed is the rule table x catalog categories
        assert plan.count("BroadcastNestedLoopJoin") <= 1, name


def test_catalog_joins_are_not_planned_as_broadcasts(spark):
    """No side is built in the driver because its file is small; operators get
    the cluster's threshold back."""
    from adlake import session

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.broadcast_by_plan(spark)
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = _plan(E.queries()["label_impressions"](spark, SF001))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    session.broadcast_by_plan(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == own
    assert [session._bytes(x) for x in ("10485760b", "256k", "10MB", "-1", "5")] == [10485760, 262144, 10485760, -1, 5]
    if before == "-1":
        session.broadcast_by_measured_size(spark)
