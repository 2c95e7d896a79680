"""SparkSession helpers.

Cluster settings (shuffle partitions, checkpoint dir, memory) belong to the
cluster; these helpers only fill in values that are unset, which is what
local tests and the bench need.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "adlake") -> SparkSession:
    """Local session for tests / bench: UTC, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ADLAKE_DRIVER_MEMORY", "16g"))
    )
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings our jobs rely on (UTC, dynamic partition overwrite)
    without touching anything the cluster already configured."""
    conf = spark.conf
    if conf.get("spark.sql.session.timeZone", None) != "UTC":
        conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    ensure_checkpoint_dir(spark)
    return spark


#: A join's side is broadcast if its rows take no more than this, as measured.
BROADCAST_BYTES = 2 << 20
_STATIC = "spark.sql.autoBroadcastJoinThreshold"
_MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"
_CLUSTER = "spark.adlake.autoBroadcastJoinThreshold"


def _bytes(size: str) -> int:
    """A size as Spark's settings write it: 10485760b, 256k, 10MB, -1."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)[a-z]*", size.strip().lower()).groups()
    return int(number) << 10 * ("kmgtp".find(unit) + 1 if unit else 0)


def broadcast_by_measured_size(spark: SparkSession) -> None:
    """Broadcast a side of a join only if its rows, once shuffled, are known to
    be small.  Planned from the sizes of files, a compressed catalog of a
    million rows passes for a few kilobytes a column, and every join with it
    builds it in the driver.  Hints keep their meaning."""
    conf = spark.conf
    if conf.get(_CLUSTER, None) is None:
        conf.set(_CLUSTER, conf.get(_STATIC))
    conf.set(_STATIC, "-1")
    conf.set(_MEASURED, str(min(_bytes(conf.get(_CLUSTER)), BROADCAST_BYTES)))


def broadcast_by_plan(spark: SparkSession) -> None:
    """The cluster's own threshold again."""
    conf = spark.conf
    if conf.get(_CLUSTER, None) is not None:
        conf.set(_STATIC, conf.get(_CLUSTER))
        conf.unset(_MEASURED)
        conf.unset(_CLUSTER)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster (a shared filesystem).  Only a
    local session may leave it unset and gets a private scratch folder."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="adlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediate
    tables (lineage cuts that survive executor loss)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df):
    """Cut lineage: write ``df`` as a Parquet table in the shared checkpoint
    folder and continue from the written copy.  Used for intermediates that
    several branches of a job read, so they are computed once (a reliable
    RDD checkpoint would compute them twice) and survive the loss of the
    executors that computed them; readers get column pruning for free."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"materialized/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
