"""Spark session helpers.

Library code never creates its own session: it receives one. These helpers
exist for tests, the bench and command-line runs on a single machine; on a
cluster the session comes from the launcher and only missing settings are
filled in.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session for tests and single-machine runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class SharedFolderError(RuntimeError):
    """No folder that all executors share is configured."""


def _configured(spark: SparkSession) -> str | None:
    return (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or os.environ.get("STRATA_CHECKPOINT_DIR"))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one: executors do not see each other's disks, so
    without it this raises. Only a single-process ``local`` master, as in
    tests, gets a folder of its own.
    """
    root = _configured(spark)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise SharedFolderError(
                f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="strata-")
    if spark.conf.get("spark.checkpoint.dir", None) != root:
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_root`, also known to ``checkpoint()``."""
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/strata/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete every scratch table of this application; returns how many there
    were. To be called when no result that reads them is needed any more."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)


MB = 1024 * 1024


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               executor_memory_mb: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet input.

    * scan splits of ``target_partition_mb`` (``maxPartitionBytes``);
    * shuffle partitions sized so that one partition is about the target
      size even if a shuffle carried the whole input (AQE then coalesces the
      many that carry less), never fewer than two waves of the cluster's
      cores;
    * a per-task memory check: the target must fit in a quarter of one
      core's share of executor memory, otherwise it is lowered;
    * AQE skew splitting for partitions over 4x the median and the target.
    """
    per_core_mb = executor_memory_mb / max(cores_per_executor, 1)
    target_mb = int(max(32, min(target_partition_mb, per_core_mb / 4)))
    slots = executors * cores_per_executor
    partitions = int(max(2 * slots, input_bytes // (target_mb * MB) + 1))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_mb}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{target_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
