"""Decision log (S-04 append, S-05 read).

One fixed nested schema for every outcome (fallback decisions carry nulls
and empty lists), stored as Parquet partitioned by decision_date and
appended by micro-batch or batch job.  A record names its candidates by group
(targeted audiences, category), each with the number of its campaigns and the
sum of their ids; :func:`candidate_sets` has the campaigns of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG, _TEXT, _NUMBER, _DAY = T.LongType(), T.StringType(), T.DoubleType(), T.DateType()
_AUDIENCES = T.ArrayType(_TEXT)


def _list_of(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


_FIELDS = {
    "request_id": _LONG,
    "user_id": _LONG,
    "ts": T.TimestampType(),
    "request_date": _DAY,
    "experiment_arm": _TEXT,
    "model_version": _TEXT,
    "candidate_set": _list_of(audiences=_AUDIENCES, category=_TEXT, campaigns=_LONG, id_sum=_LONG),
    "audience_exclusions": _list_of(
        audiences=_AUDIENCES, category=_TEXT, audience=_TEXT, definition_version=_LONG, campaigns=_LONG
    ),
    "scores": _list_of(
        audiences=_AUDIENCES, category=_TEXT, campaigns=_LONG, campaign_id=_LONG, pctr=_NUMBER, ecpm=_NUMBER,
        features=T.MapType(_TEXT, _NUMBER),
    ),
    "features_as_of": _DAY,
    "feature_age_seconds": _LONG,
    "stage_latencies_ms": T.MapType(_TEXT, _NUMBER),
    "external_bid_outcome": _TEXT,
    "external_bid": _NUMBER,
    "winner": _LONG,
    "price": _NUMBER,
    "rung": _TEXT,
    "fallback_rung": _TEXT,
}
SCHEMA = T.StructType([T.StructField(n, t) for n, t in _FIELDS.items()])


def conform(df: DataFrame) -> DataFrame:
    """Cast to the fixed schema; absent fields become nulls."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMA.fields
        ]
    )


def candidate_sets(catalog_days: DataFrame) -> DataFrame:
    """(day, audiences, category, campaign_id, bid): what the groups of a
    record's candidate set stand for, written once a day beside the log."""
    from adlake.operators.decisions import audiences_of, with_capacity

    return with_capacity(catalog_days).select(
        "day", audiences_of(F.col("targeted_audiences")).alias("audiences"), "category", "campaign_id", "bid"
    )


def append(decisions: DataFrame, path: str, files_per_day: int = 16) -> None:
    """S-04: append, partitioned by decision date."""
    out = conform(decisions).withColumn("decision_date", F.col("request_date"))
    # one day spread over several writers, each writing few files
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(files_per_day))
    out.repartition("decision_date", bucket).write.mode("append").partitionBy("decision_date").parquet(path)


def read(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """S-05: every logged decision with the fixed schema; a missing log is an
    empty DataFrame, not an error.  ``before_batch``: of a stream's log, the
    decisions of earlier micro-batches only."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return spark.createDataFrame([], SCHEMA)
    log = spark.read.parquet(path)
    return conform(log if before_batch is None else log.filter(F.col("batch_id") < before_batch))
