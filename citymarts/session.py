"""Spark session defaults used by the library, the tests and the bench."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for correct results (UTC day boundaries)
# and for runtime re-planning at scale (AQE coalesce / skew split).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition values (yyyyMM months) stay strings when tables are read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "citymarts",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``spark.checkpoint.dir`` is left to the cluster; only when it is unset
    (local runs, tests) a private scratch folder is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _is_local(spark) or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local session (tests, a laptop) gets a
    private scratch folder when it is unset; on a cluster a machine-local
    folder would not be readable by other executors, so that is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="citymarts-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


# Partition sizing (bytes of compressed input per scan split and per shuffle
# partition); see ``scale_conf``.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(
    input_bytes: int,
    cores: int | None = None,
    target_partition_bytes: int = TARGET_PARTITION_BYTES,
    expansion: float = 2.0,
    max_shuffle_partitions: int | None = None,
) -> dict:
    """Partition sizing for a run that reads ``input_bytes`` of input.

    Scan splits are ``target_partition_bytes``; the initial shuffle partition
    count is what a shuffle of the whole (decompressed, ``expansion`` x) input
    needs to stay near the target per partition, rounded up to a multiple of
    ``cores`` (whole waves). ``max_shuffle_partitions`` bounds it where the
    cluster cannot hold that many map x reduce blocks; the target per partition
    then grows so that the sizes still agree. AQE then coalesces small shuffles to the same target and splits
    partitions above twice the target in skewed joins, so one hot key does not
    become one oversized task.
    """
    wanted = math.ceil(input_bytes * expansion / target_partition_bytes)
    if max_shuffle_partitions and wanted > max_shuffle_partitions:
        target_partition_bytes = math.ceil(input_bytes * expansion / max_shuffle_partitions)
        wanted = max_shuffle_partitions
    parts = max(200, wanted)
    if cores:
        parts = math.ceil(parts / cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def input_size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (one file-system metadata call, no job)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict:
    """Set the ``scale_conf`` values the deployment has not set itself
    (cluster settings win); returns what was applied."""
    given = spark.sparkContext.getConf()
    cores = spark.sparkContext.defaultParallelism
    applied = {k: v for k, v in scale_conf(input_bytes, cores).items() if not given.contains(k)}
    for key, value in applied.items():
        spark.conf.set(key, value)
    return applied
