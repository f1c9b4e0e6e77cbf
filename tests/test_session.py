"""Session defaults, checkpoint folder and partition sizing."""

import pytest

from citymarts.session import (
    TARGET_PARTITION_BYTES,
    apply_scale_conf,
    ensure_checkpoint_dir,
    input_size,
    scale_conf,
)

TB = 1024**4


def test_scale_conf_grows_with_input():
    small = scale_conf(10 * 1024**2, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "200"
    mid = int(scale_conf(TB, cores=8)["spark.sql.shuffle.partitions"])
    assert mid == 8192 and mid % 8 == 0  # 1 TB x 2 / 256 MB
    huge = int(scale_conf(100 * TB, cores=8000)["spark.sql.shuffle.partitions"])
    assert huge >= 100 * TB * 2 // TARGET_PARTITION_BYTES and huge % 8000 == 0
    bound = scale_conf(100 * TB, max_shuffle_partitions=100_000)
    assert bound["spark.sql.shuffle.partitions"] == "100000"
    assert int(bound["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) * 100_000 >= 200 * TB
    conf = scale_conf(TB)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(TARGET_PARTITION_BYTES)
    skew = int(conf["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"])
    assert skew > int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"])


def test_apply_scale_conf_keeps_cluster_settings(spark):
    keys = list(scale_conf(TB))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        applied = apply_scale_conf(spark, TB)
        # the test session sets the shuffle partitions itself: left alone
        assert "spark.sql.shuffle.partitions" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]
        assert applied["spark.sql.files.maxPartitionBytes"] == str(TARGET_PARTITION_BYTES)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_input_size_reads_metadata(spark):
    assert input_size(spark, "/root/testdata/sf0.001/events.parquet") > 0
    assert input_size(spark, "/root/testdata/sf0.001/no-such-table") == 0


def test_checkpoint_dir_is_set(spark):
    assert spark.sparkContext.getCheckpointDir()


class _ClusterSession:
    """Just enough of a session on a cluster master with no checkpoint folder."""

    class sparkContext:  # noqa: N801
        master = "spark://cluster:7077"

        @staticmethod
        def getCheckpointDir():  # noqa: N802
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_cluster_without_checkpoint_dir_is_refused():
    """A machine-local scratch folder is only used by a local session."""
    with pytest.raises(RuntimeError, match="shared"):
        ensure_checkpoint_dir(_ClusterSession())
