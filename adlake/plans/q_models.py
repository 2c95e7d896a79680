"""Named queries: labels, as-of attribution, point-in-time training rows,
splits, evaluation and models (J-03, J-05, J-07, E-05, M-*, W-08 .. W-10,
Q-05)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from adlake import config
from adlake.operators import asof as ao
from adlake.operators import decisions as dc
from adlake.operators import features as ft
from adlake.operators import training as tr
from adlake.plans.catalog import query
from adlake.plans.q_decisions import DV, fixture_inputs, request_days, run_decisions
from adlake.plans.q_features import AS_OF
from adlake.plans.sql_views import with_views as V
from adlake.session import materialize, scratch_path
from adlake.sources import tables as tb

TRAIN_START = config.FIXTURE_START + dt.timedelta(days=config.WARMUP_DAYS)
HOLDOUT_START = AS_OF - dt.timedelta(days=config.HOLDOUT_DAYS - 1)
V1 = config.V1_FEATURES
V2 = config.V2_FEATURES


def feature_ctes(start: dt.date, n_days: int, p: str = "f") -> list[tuple[str, str]]:
    """DuckDB CTEs {p}days, {p}user(user_id, as_of_date, 4 user features),
    {p}ad(campaign_id, as_of_date, 4 ad features), {p}cat(user_id, category,
    as_of_date, cat_ctr) for n_days days from start."""
    return [
        (f"{p}days", f"SELECT CAST(DATE '{start}' + CAST(i AS INTEGER) AS DATE) AS as_of_date FROM range(0, {n_days}) t(i)"),
        (
            f"{p}ev",
            f"""SELECT e.user_id, e.campaign_id, e.category, d.as_of_date, e.event_type, d.as_of_date - e.event_date AS off
               FROM ad_events e JOIN {p}days d ON e.event_date BETWEEN d.as_of_date - 29 AND d.as_of_date""",
        ),
        (
            f"{p}user",
            f"""SELECT u.user_id, d.as_of_date,
                 CASE WHEN f.imps30 > 0 THEN f.clicks30 / f.imps30 END AS user_ctr_30d,
                 CASE WHEN f.imps7 > 0 THEN f.imps7 END AS user_impressions_7d,
                 CASE WHEN r.rides7 > 0 THEN CAST(r.rides7 AS DOUBLE) END AS user_rides_per_week,
                 CAST(d.as_of_date - u.created_at AS BIGINT) AS user_account_age_days
               FROM users u CROSS JOIN {p}days d
               LEFT JOIN (SELECT user_id, as_of_date, count(*) FILTER (WHERE event_type = 'impression') AS imps30,
                            count(*) FILTER (WHERE event_type = 'click') AS clicks30,
                            count(*) FILTER (WHERE event_type = 'impression' AND off < 7) AS imps7
                          FROM {p}ev GROUP BY user_id, as_of_date) f ON f.user_id = u.user_id AND f.as_of_date = d.as_of_date
               LEFT JOIN (SELECT r.user_id, d3.as_of_date, count(*) AS rides7 FROM rides r
                          JOIN {p}days d3 ON r.ride_date BETWEEN d3.as_of_date - 6 AND d3.as_of_date
                          GROUP BY r.user_id, d3.as_of_date) r ON r.user_id = u.user_id AND r.as_of_date = d.as_of_date""",
        ),
        (
            f"{p}ad",
            f"""SELECT c.campaign_id, d.as_of_date,
                 CASE WHEN f.imps7 > 0 THEN f.clicks7 / f.imps7 END AS ad_ctr_7d,
                 CASE WHEN f.imps30 > 0 THEN f.clicks30 / f.imps30 END AS ad_ctr_30d,
                 CASE WHEN f.imps7 > 0 THEN f.imps7 END AS ad_impressions_7d,
                 CASE WHEN c.demand_type = 'auction' THEN coalesce(f.imps_y, 0) * c.bid ELSE 0.0 END AS campaign_spend_yesterday
               FROM campaigns c CROSS JOIN {p}days d
               LEFT JOIN (SELECT campaign_id, as_of_date,
                            count(*) FILTER (WHERE event_type = 'impression') AS imps30,
                            count(*) FILTER (WHERE event_type = 'click') AS clicks30,
                            count(*) FILTER (WHERE event_type = 'impression' AND off < 7) AS imps7,
                            count(*) FILTER (WHERE event_type = 'click' AND off < 7) AS clicks7,
                            count(*) FILTER (WHERE event_type = 'impression' AND off = 1) AS imps_y
                          FROM {p}ev GROUP BY campaign_id, as_of_date) f ON f.campaign_id = c.campaign_id AND f.as_of_date = d.as_of_date""",
        ),
        (
            f"{p}cat",
            f"""SELECT user_id, category, as_of_date,
                 count(*) FILTER (WHERE event_type = 'click') / count(*) FILTER (WHERE event_type = 'impression') AS cat_ctr
               FROM {p}ev GROUP BY user_id, category, as_of_date HAVING count(*) FILTER (WHERE event_type = 'impression') > 0""",
        ),
    ]


def assembled_sql(rows: str, p: str = "f", asof_expr: str = "r.event_date") -> str:
    """Rows (user_id, campaign_id, category, hour_of_day, ...) joined to the
    feature CTEs at as_of = asof_expr, defaults filled."""
    return f"""SELECT r.*, coalesce(u.user_ctr_30d, 0.0) AS user_ctr_30d, coalesce(u.user_impressions_7d, 0) AS user_impressions_7d,
         coalesce(u.user_rides_per_week, 0.0) AS user_rides_per_week, coalesce(u.user_account_age_days, 0) AS user_account_age_days,
         coalesce(a.ad_ctr_7d, 0.0) AS ad_ctr_7d, coalesce(a.ad_ctr_30d, 0.0) AS ad_ctr_30d,
         coalesce(a.ad_impressions_7d, 0) AS ad_impressions_7d, coalesce(a.campaign_spend_yesterday, 0.0) AS campaign_spend_yesterday,
         coalesce(k.cat_ctr, 0.0) AS x_user_ctr_in_ad_category
       FROM ({rows}) r
       JOIN {p}user u ON u.user_id = r.user_id AND u.as_of_date = {asof_expr}
       JOIN {p}ad a ON a.campaign_id = r.campaign_id AND a.as_of_date = {asof_expr}
       LEFT JOIN {p}cat k ON k.user_id = r.user_id AND k.category = r.category AND k.as_of_date = {asof_expr}"""


_ATTR_SQL = """SELECT c.event_id AS click_id, c.user_id, c.campaign_id, i.event_id AS impression_id,
     (epoch_us(c.ts) - epoch_us(i.ts)) / 1000000.0 AS age_seconds
   FROM (SELECT * FROM ad_events WHERE event_type = 'click') c
   ASOF LEFT JOIN (SELECT * FROM ad_events WHERE event_type = 'impression') i
   ON c.user_id = i.user_id AND c.campaign_id = i.campaign_id AND c.ts >= i.ts"""

_LABELS = [
    ("attr", _ATTR_SQL),
    (
        "labeled",
        f"""SELECT e.event_id, e.user_id, e.campaign_id, e.category, e.event_date, e.hour_of_day,
             CAST(e.event_id IN (SELECT impression_id FROM attr WHERE impression_id IS NOT NULL) AS INTEGER) AS label
           FROM ad_events e WHERE e.event_type = 'impression' AND e.event_date BETWEEN DATE '{TRAIN_START}' AND DATE '{AS_OF}'""",
    ),
]
_N_TRAIN_DAYS = (AS_OF - TRAIN_START).days + 1
_TRAIN_CTES = _LABELS + feature_ctes(TRAIN_START, _N_TRAIN_DAYS) + [
    ("trows", assembled_sql("SELECT * FROM labeled"))
]
_TRAIN_VIEWS = ("ad_events", "users", "rides", "campaigns")


def TV(body: str) -> str:
    return V(body, *_TRAIN_VIEWS, extra=_TRAIN_CTES)


@query("attribute_clicks_asof", V("SELECT click_id, impression_id FROM attr", "ad_events", extra=[("attr", _ATTR_SQL)]))
def attribute_clicks_asof(spark, sf):
    """J-05: latest earlier impression of the same (user, campaign), no age limit."""
    return ao.attribute_clicks(tb.ad_events(spark, sf, with_category=False)).select("click_id", "impression_id")


@query(
    "attribute_clicks_user_24h",
    V(
        """SELECT c.event_id AS click_id,
             CASE WHEN epoch_us(c.ts) - epoch_us(i.ts) <= CAST(86400 AS BIGINT) * 1000000 THEN i.event_id END AS impression_id
           FROM (SELECT * FROM ad_events WHERE event_type = 'click') c
           ASOF LEFT JOIN (SELECT * FROM ad_events WHERE event_type = 'impression') i
           ON c.user_id = i.user_id AND c.ts >= i.ts""",
        "ad_events",
    ),
)
def attribute_clicks_user_24h(spark, sf):
    """J-05 with the age limit as a parameter: keyed on user only, 24 hours."""
    return ao.attribute_clicks(
        tb.ad_events(spark, sf, with_category=False), keys=("user_id",), max_age_seconds=86400
    ).select("click_id", "impression_id")


@query("label_impressions", TV("SELECT event_id, label FROM labeled"))
def label_impressions(spark, sf):
    """J-03: training-range impressions with label = some click attributed to it."""
    return ao.label_impressions(tb.ad_events(spark, sf), TRAIN_START, AS_OF).select("event_id", "label")


def _train_rows(spark, sf):
    daily = tb.user_daily_activity(spark, sf, TRAIN_START - dt.timedelta(days=29), AS_OF)
    return tr.training_rows(
        tb.ad_events(spark, sf), tb.users(spark, sf), tb.rides(spark, sf), tb.campaigns(spark, sf), TRAIN_START, AS_OF, 0,
        daily_user=daily,
    )


@query("pit_training_rows", TV("SELECT event_id, label, " + ", ".join(V1) + " FROM trows"))
def pit_training_rows(spark, sf):
    """J-07 (+ E-05, F-14): one row per labelled impression with that day's
    user and ad snapshot features (lag 0 = the reference's parity mode)."""
    return _train_rows(spark, sf).select("event_id", "label", *V1)


@query(
    "train_holdout_split",
    TV(
        f"""SELECT CASE WHEN event_date < DATE '{HOLDOUT_START}' THEN 'train' ELSE 'holdout' END AS split,
              count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM trows GROUP BY 1"""
    ),
)
def train_holdout_split(spark, sf):
    """M-01."""
    rows = _train_rows(spark, sf)
    split = F.when(F.col("event_date") < F.lit(HOLDOUT_START), "train").otherwise("holdout")
    return rows.groupBy(split.alias("split")).agg(F.count("*").alias("rows"), F.sum("label").cast("long").alias("positives"))


@query(
    "auc_popularity_baseline",
    TV(
        f"""SELECT CASE WHEN p > 0 AND n > 0 THEN num / (p * n) ELSE 'nan'::DOUBLE END AS auc, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives FROM (
              SELECT sum(pos * (neg_below + 0.5 * neg)) AS num, sum(pos) AS p, sum(neg) AS n FROM (
                SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
                FROM (SELECT ad_ctr_30d AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
                      FROM trows WHERE event_date >= DATE '{HOLDOUT_START}' GROUP BY ad_ctr_30d)))"""
    ),
)
def auc_popularity_baseline(spark, sf):
    """W-09: rank-sum AUC of the popularity baseline (ad_ctr_30d) on the
    holdout; distinct baseline scores are bounded by campaigns x days."""
    rows = _train_rows(spark, sf).filter(F.col("event_date") >= F.lit(HOLDOUT_START))
    return tr.auc_grouped(rows, "ad_ctr_30d")


@query(
    "feature_leakage_scan",
    TV(
        " UNION ALL ".join(
            f"""SELECT '{f}' AS feature, auc, greatest(auc, 1 - auc) > 0.99 AS flagged FROM (
                  SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) ELSE 'nan'::DOUBLE END AS auc
                  FROM (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
                        FROM (SELECT CAST({f} AS DOUBLE) AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
                              FROM trows GROUP BY 1)))"""
            for f in V1
        )
    ),
)
def feature_leakage_scan(spark, sf):
    """Q-05 on the production feature list (clean): per-feature AUC in one
    long-form pass; > 0.99 either way is flagged."""
    return tr.leakage_scan(_train_rows(spark, sf), V1)


@query(
    "retrain_split",
    DV(
        f"""SELECT request_id, CASE WHEN (('0x' || substr(sha256(CAST(request_id AS VARCHAR)), 1, 8))::BIGINT) % 100 < 20
                                 THEN 'holdout' ELSE 'train' END AS split
            FROM dec WHERE winner IS NOT NULL AND winner <> {config.HOUSE_AD_ID}"""
    ),
)
def retrain_split(spark, sf):
    """M-02: deterministic 20 % holdout by a hash of the request id."""
    d = run_decisions(spark, sf)["decisions"]
    real = d.filter(F.col("winner").isNotNull() & (F.col("winner") != config.HOUSE_AD_ID))
    return real.select("request_id", F.when(tr.hash_bucket("request_id") < 20, "holdout").otherwise("train").alias("split"))


# ------------------------------------------------------------------ models (R)


_FIT = {"v1": (V1, "logistic_regression"), "v2": (V2, "gbt")}


def _fitted(spark, sf, *versions):
    """Training rows (written once), holdout rows and the models asked for."""
    train, hold = tr.time_split(materialize(_train_rows(spark, sf)), HOLDOUT_START)
    return train, hold, *(tr.fit(train, *_FIT[v]) for v in versions)


def train_and_save(spark, sf, *versions) -> str:
    """M-05: fit, evaluate and save the versions; returns where they lie."""
    path = scratch_path(spark, f"pctr-{uuid.uuid4().hex}")
    train, hold, *models = _fitted(spark, sf, *versions)
    for version, model in zip(versions, models, strict=True):
        tr.save_trained(model, tr.evaluate(model, train, hold), path, version)
    return path


def _saved(spark, sf, *versions):
    path = train_and_save(spark, sf, *versions)
    return [tr.load_model(path, v) for v in versions]


@query("train_pctr_lr")
def train_pctr_lr(spark, sf):
    """M-03: fitted coefficients of the v1 logistic model (standardised)."""
    _, _, lr = _fitted(spark, sf, "v1")
    m = lr.stages[-1]
    rows = [(f, float(c)) for f, c in zip(V1, m.coefficients.toArray())] + [("intercept", float(m.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@query("train_pctr_gbt")
def train_pctr_gbt(spark, sf):
    """M-04: feature importances of the v2 boosted trees."""
    _, _, gbt = _fitted(spark, sf, "v2")
    imp = gbt.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(V2, imp)], "feature string, importance double")


@query("eval_report")
def eval_report(spark, sf):
    """M-05: the saved reports: per model AUC, popularity-baseline AUC, row
    counts and the calibration curve on the fixed holdout."""
    path = train_and_save(spark, sf, "v1", "v2")
    return spark.read.parquet(f"{path}/reports").select("model_version", "auc", "baseline_auc", "n_train", "n_holdout", "calibration")


_HOLD_SQL = f"(SELECT * FROM trows WHERE event_date >= DATE '{HOLDOUT_START}')"


@query(
    "calibration_deciles",
    TV(
        f"""SELECT bin, avg(s) AS mean_predicted, avg(CAST(label AS DOUBLE)) AS fraction_positive, count(*) AS n FROM (
              SELECT ad_ctr_30d AS s, label, CAST(len(list_filter(edges, lambda e: e < ad_ctr_30d)) AS INTEGER) AS bin FROM {_HOLD_SQL} h,
                (SELECT quantile_cont(ad_ctr_30d, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM {_HOLD_SQL}) q)
            GROUP BY bin"""
    ),
)
def calibration_deciles(spark, sf):
    """W-10: 10 equal-mass bins, by exact quantiles, of the popularity score
    on the holdout (the models' curves are in their reports)."""
    hold = _train_rows(spark, sf).filter(F.col("event_date") >= F.lit(HOLDOUT_START))
    return tr.calibration(materialize(hold), "ad_ctr_30d")


@query("calibration_by_category")
def calibration_by_category(spark, sf):
    """A-11: mean label, mean prediction and n per category on the holdout."""
    _, hold, lr = _fitted(spark, sf, "v1")
    s = tr.score(lr, hold)
    return s.groupBy("category").agg(
        F.avg(F.col("label").cast("double")).alias("observed_ctr"), F.avg("pctr").alias("mean_predicted"), F.count("*").alias("n")
    )


@query(
    "tercile_lift",
    TV(
        f"""SELECT bin, avg(s) AS mean_score, count(*) AS n FROM (
              SELECT user_ctr_30d AS s, CASE WHEN row <= n // 3 THEN 0 WHEN row > n - n // 3 THEN 2 END AS bin FROM (
                SELECT *, row_number() OVER (ORDER BY x_user_ctr_in_ad_category, event_id) AS row, count(*) OVER () AS n FROM {_HOLD_SQL}))
            WHERE bin IS NOT NULL GROUP BY bin"""
    ),
)
def tercile_lift(spark, sf):
    """W-08: mean score (the user's overall CTR) in the lowest and highest
    third of the category cross feature, on the holdout."""
    hold = _train_rows(spark, sf).filter(F.col("event_date") >= F.lit(HOLDOUT_START))
    return tr.tercile_lift(hold, "x_user_ctr_in_ad_category", "user_ctr_30d")


_ASM_START = config.FIXTURE_START - dt.timedelta(days=1)
_ASM_END = AS_OF - dt.timedelta(days=1)


def _feature_frames(spark, sf):
    """User, ad and category snapshots of the days before the requests."""
    ev = tb.ad_events(spark, sf).select("event_id", "event_type", "user_id", "campaign_id", "event_date", "category")
    ub = ft.backfill_user(tb.users(spark, sf), ev, tb.rides(spark, sf), _ASM_START, _ASM_END)
    ab = ft.backfill_ad(ev, tb.campaigns(spark, sf), _ASM_START, _ASM_END)
    ab = tr.fill_defaults(ab, tr.AD_FEATS).withColumn("day", F.date_add("asof", 1)).drop("asof")
    return ub, ab, tr.category_ctr_backfill(ev, _ASM_START, _ASM_END)


def _candidate_rows(spark, sf):
    """E-05 rows of every request: one for each group of eligible auction
    campaigns that are alike in audiences, category and ad features (of the day
    before the request: leak-free), with its best campaign."""
    ub, ab, cb = _feature_frames(spark, sf)
    inp = fixture_inputs(spark, sf)
    first, last = request_days(spark, sf)
    req = materialize(dc.request_context(inp, first, last))
    cat = dc.catalog_day_table(inp.campaigns, inp.ledger, first, last)
    groups = dc.candidate_groups(cat.join(ab, ["campaign_id", "day"], "left"), tuple(tr.AD_FEATS))
    return tr.assemble_groups(dc.model_rows(req, materialize(groups)), ub, cb)


def _arm_scorer(spark, sf, models: dict):
    """A scorer for the decision job: each arm by its pinned version."""
    ub, ab, cb = _feature_frames(spark, sf)

    def score(rows):
        rows = materialize(tr.assemble_groups(rows, ub, cb))
        parts = [tr.score(m, rows.filter(F.col("experiment_arm") == arm)) for arm, m in models.items()]
        return parts[0].unionByName(parts[1])

    return {"ad_features": ab, "scorer": score}


@query(
    "assemble_features",
    DV(
        "SELECT request_id, campaigns, campaign_id, " + ", ".join(V1) + f""" FROM (
           SELECT *, count(*) OVER (PARTITION BY request_id, audiences, category, {", ".join(tr.AD_FEATS)}) AS campaigns,
             row_number() OVER (PARTITION BY request_id, audiences, category, {", ".join(tr.AD_FEATS)}
               ORDER BY coalesce(bid, 0.0) DESC, campaign_id) AS rn FROM asm) WHERE rn = 1""",
        extra=feature_ctes(_ASM_START, (AS_OF - _ASM_START).days, "g")
        + [
            (
                "asm",
                assembled_sql(
                    """SELECT request_id, user_id, campaign_id, category, hour_of_day, request_date, bid,
                         array_to_string(list_sort(targeted_audiences), ',') AS audiences FROM elig WHERE demand_type = 'auction'""",
                    "g",
                    "r.request_date - 1",
                ),
            )
        ],
    ),
)
def assemble_features(spark, sf):
    """E-05 for serving: user + ad + cross features from the previous day's
    snapshots for every request and group of eligible auction campaigns."""
    return _candidate_rows(spark, sf).select("request_id", F.col("auctions").alias("campaigns"), "campaign_id", *V1)


@query("score_candidates")
def score_candidates(spark, sf):
    """M-07: the saved v1 model scores every group of eligible auction candidates."""
    (lr,) = _saved(spark, sf, "v1")
    return tr.score(lr, _candidate_rows(spark, sf)).select("request_id", "campaign_id", "auctions", "pctr")


@query("score_by_arm")
def score_by_arm(spark, sf):
    """M-08: control rows scored by the saved v1, treatment rows by v2; union."""
    lr, gbt = _saved(spark, sf, "v1", "v2")
    rows = materialize(_candidate_rows(spark, sf))
    a = tr.score(lr, rows.filter(F.col("experiment_arm") == "control")).withColumn("model_version", F.lit("v1"))
    b = tr.score(gbt, rows.filter(F.col("experiment_arm") == "treatment")).withColumn("model_version", F.lit("v2"))
    return a.unionByName(b).select("request_id", "campaign_id", "experiment_arm", "model_version", "pctr")


def _model_decisions(spark, sf):
    lr, gbt = _saved(spark, sf, "v1", "v2")
    return run_decisions(spark, sf, **_arm_scorer(spark, sf, {"control": lr, "treatment": gbt}))


@query("candidate_ecpm_model")
def candidate_ecpm_model(spark, sf):
    """D-04 with model scores: the decision job with arm-pinned model pctr
    instead of the stand-in score."""
    return _model_decisions(spark, sf)["scored"].select("request_id", "campaign_id", "pctr", "ecpm")


def _logged_wins(decisions):
    """M-06 rows: real auction wins with the features that were logged with
    the winner's score."""
    from adlake.operators import reports as rp

    w = rp.winner_features(decisions)
    return w.select("request_id", F.col("winner").alias("campaign_id"), "category", *[F.col("features")[f].alias(f) for f in V1])


@query("retrain_report")
def retrain_report(spark, sf):
    """M-06: retrain from the decision log: real auction wins, the features
    logged with their scores (+ session flag), real click labels, hash split;
    compares the retrained model with the live v1 on one holdout."""
    from adlake.operators import reports as rp
    from adlake.operators import session_features as sfo

    d = _model_decisions(spark, sf)["decisions"]
    clicked = rp.decision_clicks(d, tb.ad_events(spark, sf, with_category=False)).withColumn("label", F.lit(1))
    rows = _logged_wins(d).join(clicked, "request_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))
    active = sfo.session_active_at_requests(tb.session_events(spark, sf), d.select("request_id", "user_id", "ts"))
    rows = materialize(rows.join(active, "request_id", "left").withColumn(
        "user_session_active", F.coalesce("user_session_active", F.lit(0)).cast("int")
    ))
    n = rows.count()
    if n == 0:
        raise ValueError("no retrain rows in the decision log")
    train, hold = tr.hash_split(rows, "request_id")
    v3 = tr.fit(train, config.V3_FEATURES, "logistic_regression")
    _, _, live = _fitted(spark, sf, "v1")
    out = [
        ("v3", tr.auc_model(tr.score(v3, hold), "pctr"), train.count(), hold.count()),
        ("v1", tr.auc_model(tr.score(live, hold), "pctr"), train.count(), hold.count()),
    ]
    return spark.createDataFrame(out, "model_version string, auc double, n_train long, n_holdout long")


@query(
    "retrain_rows",
    DV(
        """SELECT d.request_id, d.winner FROM dec d JOIN scored s ON s.request_id = d.request_id AND s.campaign_id = d.winner
           WHERE d.full_path"""
    ),
)
def retrain_rows(spark, sf):
    """M-06 rows: real wins whose winner carries logged scores."""
    from adlake.operators import reports as rp

    return rp.winner_features(run_decisions(spark, sf)["decisions"]).select("request_id", "winner")



# ------------------------------------------------------- published snapshots

from adlake.plans import q_quality as qq  # noqa: E402
from adlake.plans.catalog import ORACLE  # noqa: E402

ORACLE["published_user_features"] = qq._user_day_sql()
ORACLE["published_membership_versions"] = V(
    "SELECT user_id, audience, definition_version, as_of_date FROM mem_long", "user_segments", "ad_events", "rides",
    extra=qq.membership_ctes(AS_OF - dt.timedelta(days=1), 2),
)
