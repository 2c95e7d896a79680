"""Training sets, models and evaluation (J-03, J-07, E-05, F-14, M-01 ..
M-08, W-08 .. W-10, Q-05).

Point-in-time join: every impression reads the snapshot of its own day
minus ``lag_days`` (0 = the reference's same-day snapshot, 1 = leak-free).
The snapshots are the one-pass backfill frames, so the join is two
equi-joins on (id, asof) - no per-day loop."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake import config
from adlake.functions.scalar import lit_date
from adlake.operators import features as ft
from adlake.operators.asof import label_impressions
from adlake.operators.ranks import quantiles, row_numbers, with_sums_before
from adlake.session import materialize

USER_FEATS = ["user_ctr_30d", "user_impressions_7d", "user_rides_per_week", "user_account_age_days"]
AD_FEATS = ["ad_ctr_7d", "ad_ctr_30d", "ad_impressions_7d", "campaign_spend_yesterday"]


def registry_defaults() -> dict[str, object]:
    return {n: d for n, _, _, _, _, d in config.REGISTRY}


def fill_defaults(df: DataFrame, names: list[str]) -> DataFrame:
    """F-14: coalesce(col, registry default) for registered names."""
    d = registry_defaults()
    return df.select(*[F.coalesce(F.col(c), F.lit(d[c])).alias(c) if c in names and c in d else F.col(c) for c in df.columns])


def category_ctr_backfill(ad_events: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """(user_id, category, asof, ctr30) for every day with data in the window."""
    first = start - dt.timedelta(days=29)
    ev = ad_events.filter(F.col("event_date").between(lit_date(first), lit_date(end)))
    daily = ev.groupBy("user_id", "category", "event_date").agg(
        F.count_if(ft.IMP()).alias("imps"), F.count_if(ft.CLK()).alias("clicks")
    )
    agg = ft.rolling_days(daily, ["user_id", "category"], {"i": ("imps", 0, 29), "c": ("clicks", 0, 29)}, start, end)
    return agg.filter(F.col("i") > 0).select("user_id", "category", "asof", (F.col("c") / F.col("i")).alias("cat_ctr"))


def assemble(
    rows: DataFrame, user_bf: DataFrame, ad_bf: DataFrame, cat_bf: DataFrame, asof_col: str = "asof"
) -> DataFrame:
    """E-05: user + ad + cross features for (user_id, campaign_id, category,
    asof) rows; rows whose user or ad snapshot is missing are dropped; the
    cross x_user_ctr_in_ad_category defaults to 0.0; registry defaults fill
    the rest."""
    u = user_bf.select("user_id", F.col("asof").alias(asof_col), *USER_FEATS)
    a = ad_bf.select("campaign_id", F.col("asof").alias(asof_col), *AD_FEATS)
    c = cat_bf.select("user_id", "category", F.col("asof").alias(asof_col), "cat_ctr")
    j = rows.join(u, ["user_id", asof_col]).join(a, ["campaign_id", asof_col]).join(
        c, ["user_id", "category", asof_col], "left"
    )
    j = j.withColumn("x_user_ctr_in_ad_category", F.coalesce("cat_ctr", F.lit(0.0))).drop("cat_ctr")
    return fill_defaults(j, USER_FEATS + AD_FEATS)


def assemble_groups(rows: DataFrame, user_bf: DataFrame, cat_bf: DataFrame) -> DataFrame:
    """E-05 for rows that carry their ad features: user and cross features as
    of ``asof``; rows without a user snapshot are dropped, defaults fill the rest."""
    u = user_bf.select("user_id", "asof", *USER_FEATS)
    c = cat_bf.select("user_id", "category", "asof", "cat_ctr")
    j = rows.join(u, ["user_id", "asof"]).join(c, ["user_id", "category", "asof"], "left")
    j = j.withColumn("x_user_ctr_in_ad_category", F.coalesce("cat_ctr", F.lit(0.0))).drop("cat_ctr")
    return fill_defaults(j, USER_FEATS + AD_FEATS)


def training_rows(
    ad_events: DataFrame,
    users: DataFrame,
    rides: DataFrame,
    campaigns: DataFrame,
    start: dt.date,
    end: dt.date,
    lag_days: int = 0,
    daily_user: DataFrame | None = None,
) -> DataFrame:
    """J-07: labelled impressions in [start, end] with point-in-time features.
    ``daily_user`` (user_id, event_date, imps, clicks, rides) lets the user
    backfill reuse a one-scan daily aggregate."""
    imps = label_impressions(ad_events, start, end).withColumn("asof", F.date_sub("event_date", lag_days))
    s, e = start - dt.timedelta(days=lag_days), end - dt.timedelta(days=lag_days)
    ev = ad_events.select("event_id", "event_type", "user_id", "campaign_id", "event_date", "category")
    ub = ft.backfill_user(users, ev, rides, s, e, daily=daily_user)
    ab = ft.backfill_ad(ev, campaigns, s, e)
    cb = category_ctr_backfill(ev, s, e)
    rows = imps.select("event_id", "user_id", "campaign_id", "category", "event_date", "hour_of_day", "label", "asof")
    return assemble(rows, ub, ab, cb).select(
        "event_id", "user_id", "campaign_id", "category", "event_date", "label", *config.V1_FEATURES
    )


def save_trained(model: PipelineModel, report: DataFrame, path: str, version: str) -> None:
    """M-05: a fitted pipeline and its report, by version."""
    model.write().overwrite().save(f"{path}/models/{version}")
    report.withColumn("model_version", F.lit(version)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("model_version").parquet(f"{path}/reports")


def load_model(path: str, version: str) -> PipelineModel:
    """M-07 / X-04: the saved pipeline of a version."""
    return PipelineModel.load(f"{path}/models/{version}")


REPORT = (
    "auc double, baseline_auc double, n_train long, n_holdout long, "
    "calibration array<struct<bin: int, mean_predicted: double, fraction_positive: double, n: long>>"
)


def evaluate(model: PipelineModel, train: DataFrame, holdout: DataFrame, baseline_col: str = "ad_ctr_30d") -> DataFrame:
    """M-05 report, one row: AUC of the model and of the popularity baseline,
    row counts and the calibration curve on the holdout."""
    scored = materialize(score(model, holdout))
    curve = [tuple(r) for r in calibration(scored, "pctr").select("bin", "mean_predicted", "fraction_positive", "n").orderBy("bin").collect()]
    base = auc_grouped(holdout, baseline_col).first()["auc"]
    row = (float(auc_model(scored, "pctr")), float(base), train.count(), holdout.count(), curve)
    return holdout.sparkSession.createDataFrame([row], REPORT)


def time_split(rows: DataFrame, holdout_start: dt.date) -> tuple[DataFrame, DataFrame]:
    """M-01: train before holdout_start, holdout from it (warm-up days are
    excluded by the training range itself)."""
    return rows.filter(F.col("event_date") < lit_date(holdout_start)), rows.filter(
        F.col("event_date") >= lit_date(holdout_start)
    )


def hash_bucket(key) -> F.Column:
    """M-02: a stable 0..99 bucket from the first 8 hex digits of sha256 -
    the same digits are available to the SQL oracle."""
    h = F.sha2(F.col(key).cast("string"), 256)
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 100).cast("int")


def hash_split(rows: DataFrame, key: str, holdout_fraction: float = config.RETRAIN_HOLDOUT_FRACTION):
    b = hash_bucket(key)
    cut = int(round(holdout_fraction * 100))
    return rows.filter(b >= cut), rows.filter(b < cut)


# ------------------------------------------------------------------ models


def lr_pipeline(features: list[str], n_train: int) -> Pipeline:
    """M-03: standardise, then L2 logistic regression.  scikit-learn's C=1
    on a summed loss equals regParam = 1 / n on Spark's averaged loss."""
    reg = 1.0 / max(n_train, 1)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="error"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=0.0,
                               standardization=False, maxIter=200),
        ]
    )


def gbt_pipeline(features: list[str]) -> Pipeline:
    """M-04: 100 boosted trees, depth 3, seed 42."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"),
            GBTClassifier(featuresCol="features", labelCol="label", maxDepth=3, maxIter=100, seed=42),
        ]
    )


def fit(rows: DataFrame, features: list[str], algorithm: str) -> PipelineModel:
    data = rows.select(*features, F.col("label").cast("double").alias("label"))
    if algorithm == "logistic_regression":
        return lr_pipeline(features, data.count()).fit(data)
    if algorithm == "gbt":
        return gbt_pipeline(features).fit(data)
    raise ValueError(f"unknown algorithm {algorithm!r}")


def score(model: PipelineModel, rows: DataFrame, out: str = "pctr") -> DataFrame:
    """M-07: probability of class 1 as a double column (missing feature
    columns fail at plan time)."""
    keep = rows.columns
    pred = model.transform(rows)
    return pred.select(*keep, vector_to_array("probability")[1].alias(out))


# --------------------------------------------------------------- evaluation


def auc_grouped(df: DataFrame, score_col: str, label_col: str = "label", by: list[str] | None = None) -> DataFrame:
    """W-09 rank-sum AUC with half credit for ties, per group ``by``.

    Rows are first reduced to (group, score) counts of positives and
    negatives; the negatives below each distinct score come from ranks by
    range.  NaN when a group has one class only."""
    by = by or []
    g = df.groupBy(*by, F.col(score_col).alias("s")).agg(
        F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) != 1).alias("neg")
    )
    g = with_sums_before(g, by, ["s"], {"neg_below": "neg"})
    agg = g.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    return agg.select(
        *by,
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P") * F.col("N"))).otherwise(F.lit(float("nan"))).alias("auc"),
        F.col("P").alias("positives"),
        F.col("N").alias("negatives"),
    )


def auc_model(df: DataFrame, score_col: str, label_col: str = "label") -> float:
    """W-09 for continuous scores: MLlib's distributed (range-partitioned)
    ROC with every threshold (numBins=0), i.e. the exact trapezoid area."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label_col, metricName="areaUnderROC", numBins=0)
    return ev.evaluate(df.select(F.col(score_col).cast("double"), F.col(label_col).cast("double")))


def calibration(df: DataFrame, score_col: str, label_col: str = "label", n_bins: int = 10) -> DataFrame:
    """W-10: equal-mass bins of the score by its exact quantiles (a score on
    an edge belongs to the bin below it); mean prediction and positive share
    per non-empty bin."""
    edges = quantiles(df, score_col, [i / n_bins for i in range(1, n_bins)])
    index = F.lit(0)
    for e in edges:
        index = index + F.when(F.col(score_col) > F.lit(e), 1).otherwise(0)
    return df.withColumn("bin", index).groupBy("bin").agg(
        F.avg(score_col).alias("mean_predicted"), F.avg(F.col(label_col).cast("double")).alias("fraction_positive"),
        F.count("*").alias("n"),
    )


def tercile_lift(df: DataFrame, feature: str, score_col: str, id_col: str = "event_id") -> DataFrame:
    """W-08: mean score in the lowest and highest third of a feature: the
    first and last n // 3 rows in order of (feature, id)."""
    ranked = materialize(row_numbers(df.select(*dict.fromkeys([feature, score_col, id_col])), [feature, id_col], "row"))
    third, n = ranked.count() // 3, ranked.count()
    bin_ = F.when(F.col("row") <= third, 0).when(F.col("row") > n - third, 2)
    return ranked.withColumn("bin", bin_).filter("bin is not null").groupBy("bin").agg(
        F.avg(score_col).alias("mean_score"), F.count("*").alias("n")
    )


def leakage_scan(rows: DataFrame, features: list[str], threshold: float = 0.99) -> DataFrame:
    """Q-05: per-feature AUC against the label in ONE long-form pass; a
    feature whose AUC (either direction) exceeds the threshold is flagged."""
    long = rows.select(
        "label",
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("x"),
    ).select("label", "x.feature", "x.v")
    a = auc_grouped(long, "v", by=["feature"])
    return a.select(
        "feature", "auc", (F.greatest(F.col("auc"), 1 - F.col("auc")) > threshold).alias("flagged")
    )
