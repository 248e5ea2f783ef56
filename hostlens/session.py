"""Session and shared-storage helpers.

Jobs never pick a machine-local scratch folder on their own: every
materialisation (checkpoint, file round trip) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  Only on a ``local`` master (unit
tests, a laptop) does a missing setting mean a fresh temporary folder; on a
cluster it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "hostlens") -> SparkSession:
    """Session used by tests and the bench (the cluster supplies its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def cluster_settings(input_bytes: int, cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Starting configuration for a large cluster run.

    Shuffle partitions are sized so that one partition of the biggest
    shuffle holds about ``target_partition_mb`` (AQE then coalesces the
    small shuffles and splits skewed partitions at run time); scans use the
    same split size.  At 100 TB and 256 MB this gives ~400k partitions.
    """
    parts = max(cores * 2, input_bytes // (target_partition_mb << 20))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Read from the session (the cluster's setting wins); set one only where
    it is unset.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="hostlens-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "hostlens-scratch", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared folder
    and reading it back.

    Unlike ``localCheckpoint`` the copy survives the loss of an executor, and
    unlike ``Dataset.checkpoint`` on an unpersisted plan it computes the
    plan once.  Use it where one result feeds two branches.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
