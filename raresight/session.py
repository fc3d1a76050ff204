"""Spark session and shared-folder helpers.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``.
We read that setting from the session and only create our own folder when it is
unset *and* Spark runs in local mode (tests, benches).  On a cluster an unset
folder is an error: a machine-local temp folder would not survive executor loss.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the data: ~256 MB scan splits, enough initial shuffle partitions
    for the un-aggregated worst case (every row shuffled), which AQE then coalesces to
    ~128 MB; skewed partitions above 5x the median and 512 MB are split.

    At 100 TB on 1,000 executors x 8 cores this gives ~400k scan tasks and 400k initial
    shuffle partitions (coalesced at run time), so no partition outgrows executor memory.
    """
    parts = max(total_cores * 2, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "raresight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    local = tempfile.mkdtemp(prefix="raresight-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def stored(df, name: str):
    """``df`` written once to the shared folder and read back.  Later actions don't recompute it, and a join with
    it is sized by its files: Catalyst broadcasts it below ``autoBroadcastJoinThreshold`` and shuffles beyond."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
