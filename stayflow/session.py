"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "stayflow", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own session)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster setting wins. Only in local mode, and when nothing is configured
    (tests), a folder under the system temp dir is taken; on a cluster every executor would write to its own disk there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stayflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for build-once tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if not base.startswith("file:") else "/".join([base.rstrip("/"), *parts])


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 * 1024 ** 2, shuffle_expansion: float = 1.0) -> dict:
    """Session settings sized for a volume of input, so partitions fit in executor memory.

    * post-shuffle partitions: enough that each holds ~``target_partition_bytes``
      of shuffled data (``input_bytes * shuffle_expansion``), never fewer than
      two waves of the cluster's task slots; AQE coalesces small ones at runtime;
    * file splits of the same size, so scan tasks are equally sized;
    * AQE with partition coalescing and skew-join splitting (a key holding a
      large share of rows is split across tasks), broadcast only below a
      runtime-measured size.
    """
    slots = max(1, executors * cores_per_executor)
    by_volume = int(-(-input_bytes * shuffle_expansion // target_partition_bytes))
    partitions = max(2 * slots, by_volume)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
