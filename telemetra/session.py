"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions and file split size are left to the
# caller for cluster runs; AQE coalesces small shuffles and splits skewed join partitions.
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


# Settings for a large cluster (~1000 executors, ~100 TB inputs). Shuffles start with many
# partitions and AQE coalesces them to ~256 MB each, so one setting serves small and huge
# stages; scan splits are larger than the 128 MB default; a partition 5x the median and over
# 512 MB counts as skewed and is split; joins switch to broadcast at runtime only below 64 MB
# of measured shuffle output; streaming state lives in RocksDB instead of executor heap.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(512 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "telemetra", extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="local"``: tests and benchmarks; ``profile="cluster"``: CLUSTER_CONF on top of
    the defaults (master then comes from spark-submit: pass ``master=None``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> tuple[str, int]:
    """Identity of a live session for per-session caches: a stopped and recreated session gets
    a new application id even if Python reuses the object's address."""
    return spark.sparkContext.applicationId, id(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints / intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file system).
    Only when the session leaves it unset (local tests) is a scratch folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="telemetra-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")
