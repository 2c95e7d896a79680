"""The gated write path: a bad day changes nothing, a good one replaces its own."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from adlake.operators import quality as qc
from adlake.session import scratch_path
from adlake.sources import publish as pb
from adlake.sources import snapshots as ss

D0 = dt.date(2026, 7, 14)


def jobs(spark, rows, spend=None, expected=4):
    ctr = spark.createDataFrame(rows, "campaign_id long, ad_ctr_7d double")
    money = spark.createDataFrame(spend or [(i, 0.0) for i in range(4)], "campaign_id long, campaign_spend_yesterday double")
    return [pb.Job("ctr", ctr, expected), pb.Job("spend", money, 4)]


def published(spark, root):
    return sorted((r.campaign_id, r.ad_ctr_7d) for r in ss.query_as_of(spark, root, "ad", D0).collect())


def test_a_poisoned_day_leaves_what_was_published(spark):
    root = scratch_path(spark, f"t-store-{uuid.uuid4().hex}")
    good = [(i, 0.5) for i in range(4)]
    report = pb.publish_day(spark, root, "ad", jobs(spark, good), D0)
    assert report.filter("row_check_passed and null_check_passed").count() == 2
    before = published(spark, root)
    bad = [[(0, 0.5), (1, 0.5), (None, 0.5), (None, 0.5)], [(0, None), (1, 0.5), (2, 0.5), (3, 0.5)]]
    for rows in bad:  # half of the ids lost; a quarter of the values null
        with pytest.raises(qc.QualityGateError):
            pb.publish_day(spark, root, "ad", jobs(spark, rows), D0)
        assert published(spark, root) == before == good
    assert pb.items(spark, root, "ad", D0).count() == 8


def test_a_day_is_replaced_alone(spark):
    root = scratch_path(spark, f"t-store-{uuid.uuid4().hex}")
    next_day = D0 + dt.timedelta(days=1)
    pb.publish_day(spark, root, "ad", jobs(spark, [(i, 0.1) for i in range(4)]), D0)
    pb.publish_day(spark, root, "ad", jobs(spark, [(i, 0.2) for i in range(4)]), next_day)
    pb.publish_day(spark, root, "ad", jobs(spark, [(i, 0.3) for i in range(3)], expected=0), D0)
    days = {(r["asof"], r.ad_ctr_7d): r.n for r in ss.read_entity(spark, root, "ad").groupBy("asof", "ad_ctr_7d").agg(F.count("*").alias("n")).collect()}
    assert days == {(D0, 0.3): 3, (D0, None): 1, (next_day, 0.2): 4}
    # exactly 80 % of the rows pass, and null ids are never published
    five = [(i, 0.4) for i in range(4)] + [(None, 0.4)]
    pb.publish_day(spark, root, "ad", jobs(spark, five, expected=5), D0)
    assert len(published(spark, root)) == 4


def test_contract_is_checked_before_anything_is_staged(spark):
    root = scratch_path(spark, f"t-store-{uuid.uuid4().hex}")
    wrong = spark.createDataFrame([(1, 0.5)], "campaign_id long, user_ctr_30d double")
    with pytest.raises(qc.ContractError):
        pb.publish_day(spark, root, "ad", [pb.Job("wrong", wrong, 0)], D0)
    assert not ss._exists(spark, root)
