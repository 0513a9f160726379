"""Spark session settings for sensor time-series work.

Event time is always interpreted in UTC; AQE is on so shuffle widths, skewed
joins and runtime broadcasts are decided from measured sizes; state of
streaming queries lives in RocksDB so it can spill past executor memory.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every sensorflow job relies on. Cluster-level settings (executor
# sizes, checkpoint dir) are left to whoever launches the job.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # plan texts show whole filter lists: what prunes folders can be read there
    "spark.sql.maxMetadataStringLength": "2000",
    "spark.ui.enabled": "false",
}


def get_session(
    app: str = "sensorflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the sensorflow defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone: epoch values map to UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    It comes from ``spark.checkpoint.dir``, a folder every executor can reach.
    A missing setting is an error, on every master: a folder made up for one
    process would let a restarted query begin again from the earliest offset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """Per-query checkpoint folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), name)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a folder of its own under the shared checkpoint root, and read back.

    What follows sees the same rows in every branch and every recomputed
    task. The folder stays; it may be removed when the result is written.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int,
               target_bytes: int = 512 * 1024 * 1024, max_per_core: int = 50) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``total_cores``.

    Initial shuffle partitions ~ one per ``target_bytes`` of input, at least
    2 and at most ``max_per_core`` per core; AQE then coalesces partitions that
    came out small (partial aggregation and column pruning shrink most
    shuffles) toward the advisory size. Scan splits stay at 256 MB so a task's
    working set fits executor memory and spills are rare.
    """
    wanted = -(-input_bytes // target_bytes)
    shuffle = int(min(max(wanted, 2 * total_cores), max_per_core * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }
