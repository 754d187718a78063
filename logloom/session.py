"""Session helpers for tests, the bench and the driver entry point."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every logloom job relies on: UTC wall clock (log offsets are
# parsed explicitly), AQE for runtime coalescing and skew splitting, and
# Arrow for the numpy stages.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "logloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LOGLOOM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    A folder of our own is chosen only when the setting is absent and the
    master is local (tests, the local bench)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext.getCheckpointDir()
        if jdir:
            path = jdir
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; point it at a shared folder")
        path = tempfile.mkdtemp(prefix="logloom-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Suggested settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least two waves of tasks) and AQE coalesces them down at run
    time; scans split at the same size; AQE splits skewed join partitions.
    Pass the result to ``build_session(extra=...)`` or a submit command."""
    parts = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
