"""Session settings and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the toolkit relies on. Time zone is pinned so zoned
# text becomes the same instant everywhere; AQE coalesces small shuffles,
# splits skewed join partitions and turns joins with a small runtime side
# into broadcast joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster profile for data in the 100 TB range (1,000+ executors). Shuffles
# start wide and AQE coalesces them to ~256 MB partitions; scans split files
# at 256 MB; a partition 4x the median and above 512 MB counts as skewed and
# is split; runtime broadcasts stay small; stragglers are re-launched and lost
# executors are tolerated by task and stage retries.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.speculation": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "sluice",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the toolkit's settings.

    ``profile="cluster"`` adds ``CLUSTER_CONF``; the cluster must name a
    shared ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only pick our own
    folder when nothing is configured and the master is local (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server owns the setting
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return root
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sluice/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for tools that only take local paths."""
    if uri.startswith("file:"):
        uri = uri[5:]
        while uri.startswith("//"):
            uri = uri[1:]
    return uri


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df):
    """Reliable checkpoint into the shared folder: cuts lineage so later
    stages (and retries after a lost executor) read the written data instead
    of recomputing it. Never a local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
