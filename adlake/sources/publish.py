"""One gated write path for both entities (S-02, S-07, S-08, J-02, P-05, Q-01,
Q-03): stage, gate, publish.

The jobs of a day are merged and written to a staging folder.  The gate is one
aggregate over what was staged: rows of each job against its expected
population, and the nulls of each feature.  If any check fails, an error is
raised and nothing published changes.  Otherwise the staged day replaces the
published one: its snapshot partition, its long-form items and (users) its
membership rows.  A partition is replaced when Spark commits the write, so
readers see the old day or the new one, and a repeated run of a day replaces
that day only."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake import config
from adlake.operators import quality as qc
from adlake.operators.features import merge_entity_frames
from adlake.sources import snapshots as ss


@dataclass
class Job:
    """Features of one job: a frame of the entity's id and its outputs, and
    how many entities it should cover (0: no row check)."""

    name: str
    frame: DataFrame
    expected: int

    def outputs(self, key: str) -> list[str]:
        return [c for c in self.frame.columns if c != key]


def _marker(k: int) -> str:
    return f"__job_{k}"


def staged_day(spark: SparkSession, root: str, entity: str, jobs: list[Job]) -> DataFrame:
    """The jobs' frames, checked against their contract, without null ids,
    merged by id and written to the staging folder; one marker a job."""
    key = ss.ENTITY_KEY[entity]
    frames = []
    for k, job in enumerate(jobs):
        qc.check_output_contract(job.frame, key, job.outputs(key), entity)
        frames.append(job.frame.filter(F.col(key).isNotNull()).withColumn(_marker(k), F.lit(True)))
    path = f"{root.rstrip('/')}/_staging/{entity}-{uuid.uuid4().hex}"
    merged = merge_entity_frames(frames, key)
    merged.write.parquet(path)
    return spark.read.schema(merged.schema).parquet(path)


def day_report(staged: DataFrame, key: str, jobs: list[Job]) -> DataFrame:
    """Q-01 over all jobs of a staged day, from one aggregate."""
    aggs, rows = [], []
    for k, job in enumerate(jobs):
        mine = F.coalesce(F.col(_marker(k)), F.lit(False))
        aggs.append(F.count_if(mine).alias(f"rows_{k}"))
        for c in job.outputs(key):
            aggs.append(F.count_if(mine & F.col(c).isNull()).alias(f"null_{c}"))
            rows.append(
                F.struct(
                    F.lit(job.name).alias("job"), F.lit(c).alias("feature"), F.col(f"rows_{k}").alias("rows"),
                    F.lit(job.expected).cast("long").alias("expected"), F.col(f"null_{c}").alias("null_count"),
                )
            )
    r = staged.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    share = F.col("rows").cast("double") / F.col("expected")
    nulls = F.col("null_count").cast("double") / F.col("rows")
    return r.select(
        "*",
        ((F.col("expected") == 0) | (share >= config.MIN_ROW_COUNT_RATIO)).alias("row_check_passed"),
        ((F.col("rows") == 0) | (nulls <= config.MAX_NULL_RATE)).alias("null_check_passed"),
    )


def publish_day(spark: SparkSession, root: str, entity: str, jobs: list[Job], as_of: dt.date) -> DataFrame:
    """Stage, gate and publish one day of an entity; returns the gate report.
    Raises :class:`quality.QualityGateError` with everything published left as
    it was."""
    key = ss.ENTITY_KEY[entity]
    staged = staged_day(spark, root, entity, jobs)
    report = day_report(staged, key, jobs)
    qc.enforce(report)
    names = [c for job in jobs for c in job.outputs(key)]
    day = staged.select(key, *names, F.lit(as_of).alias("asof"))
    ss.write_snapshot(day, root, entity)
    computed_at = dt.datetime.combine(as_of + dt.timedelta(days=1), dt.time())
    items = ss.to_long(day.drop("asof"), entity, names, computed_at)
    _replace(items.withColumns({"entity": F.lit(entity), "asof": F.lit(as_of)}), f"{root}/items", "entity_key", ["entity", "asof"])
    if "audience_memberships" in names:
        versions = F.create_map(*[x for a in config.fixture_audiences() for x in (F.lit(a.name), F.lit(a.version).cast("long"))])
        long = day.select(key, F.explode("audience_memberships").alias("audience"), "asof")
        long = long.withColumn("definition_version", F.coalesce(F.try_element_at(versions, F.col("audience")), F.lit(-1).cast("long")))
        _replace(long, f"{root}/memberships", key, ["asof"])
    return report


def _replace(df: DataFrame, path: str, key: str, by: list[str], files: int = 16) -> None:
    """Replace the partitions that ``df`` holds; a day is spread over tasks."""
    bucket = F.pmod(F.xxhash64(key), F.lit(files))
    df.repartition(*by, bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def items(spark: SparkSession, root: str, entity: str, as_of: dt.date) -> DataFrame:
    """E-02: the published long-form items of a day."""
    df = spark.read.parquet(f"{root.rstrip('/')}/items")
    return df.filter((F.col("entity") == entity) & (F.col("asof") == F.lit(as_of)))


def memberships(spark: SparkSession, root: str) -> DataFrame:
    """S-08: all published (user_id, audience, definition_version, asof)."""
    kinds = "user_id long, audience string, definition_version long, asof date"
    return spark.read.schema(kinds).parquet(f"{root.rstrip('/')}/memberships")
