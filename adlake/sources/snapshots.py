"""Feature snapshot store (S-02, S-03, J-06) and long-form publish (S-07).

Layout: ``<root>/entity=<user|ad>/asof=<yyyy-mm-dd>/part-*.parquet``: one
Parquet dataset per entity (the columns differ), partitioned by ``asof``
so as-of reads prune to a single partition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake import config


def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/entity={entity}"


def write_snapshot(df: DataFrame, root: str, entity: str, asof_col: str = "asof", files_per_day: int = 16) -> None:
    """S-02: overwrite only the asof partitions present in ``df`` (dynamic
    partition overwrite).  Rows are clustered by (asof, hash bucket of the
    entity id): one day is spread over ``files_per_day`` tasks (a day is
    never a single task) and each task writes few files."""
    key = ENTITY_KEY[entity]
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_day))
    (
        df.repartition(asof_col, bucket)
        .sortWithinPartitions(asof_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(asof_col)
        .parquet(entity_path(root, entity))
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_entity(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    p = entity_path(root, entity)
    if not _exists(spark, p):
        return None
    return spark.read.option("basePath", p).parquet(p)


def snapshot_dates(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """S-03: sorted distinct partition dates (empty if none).  Reads only the
    partition column, i.e. the directory listing."""
    df = read_entity(spark, root, entity)
    if df is None:
        return spark.createDataFrame([], T.StructType([T.StructField("asof", T.DateType())]))
    return df.select(F.col("asof").cast("date").alias("asof")).distinct()


def query_as_of(spark: SparkSession, root: str, entity: str, as_of: dt.date) -> DataFrame | None:
    """J-06: the WHOLE snapshot with the largest asof <= as_of (no per-entity
    fall-back to older partitions); None when no such partition exists.

    The partition date is resolved from the listing (a tiny job over the
    partition column only), then the read is a pruned partition scan."""
    dates = snapshot_dates(spark, root, entity).filter(F.col("asof") <= F.lit(as_of))
    row = dates.agg(F.max("asof").alias("d")).first()
    if row is None or row["d"] is None:
        return None
    df = read_entity(spark, root, entity)
    return df.filter(F.col("asof") == F.lit(row["d"]))


ENTITY_PREFIX = {"user": "user", "ad": "ad"}
ENTITY_KEY = {"user": "user_id", "ad": "campaign_id"}


def to_long(df: DataFrame, entity: str, feature_names: list[str], computed_at: dt.datetime) -> DataFrame:
    """S-07: one item per non-null (entity, feature): key 'user#id' / 'ad#id',
    feature_name, value as JSON text, computed_at.  unpivot, not a loop."""
    key = ENTITY_KEY[entity]
    vals = df.select(
        key,
        *[F.to_json(F.struct(F.col(n).alias("v"))).alias(n) for n in feature_names],
        *[F.col(n).isNull().alias(f"__null_{n}") for n in feature_names],
    )
    stacked = vals.select(
        key,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("feature_name"),
                        F.col(n).alias("value_json"),
                        F.col(f"__null_{n}").alias("is_null"),
                    )
                    for n in feature_names
                ]
            )
        ).alias("s"),
    )
    return stacked.filter(~F.col("s.is_null")).select(
        F.concat_ws("#", F.lit(ENTITY_PREFIX[entity]), F.col(key).cast("string")).alias("entity_key"),
        F.col("s.feature_name").alias("feature_name"),
        # {"v": X} -> X
        F.expr("substring(s.value_json, 6, length(s.value_json) - 6)").alias("value_json"),
        F.lit(computed_at).cast("timestamp").alias("computed_at"),
    )
