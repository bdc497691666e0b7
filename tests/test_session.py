"""Session helpers: checkpoint folder and scale settings."""

from stationdw.session import checkpoint_root, scale_conf, scratch_dir


def test_checkpoint_folder_is_set_and_scratch_is_fresh(spark):
    root = checkpoint_root(spark)
    assert root and spark.sparkContext.getCheckpointDir() == root
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_scale_conf():
    conf = scale_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024
    assert int(scale_conf(10 << 40, 800)["spark.sql.shuffle.partitions"]) == 10 * 1024
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    small = scale_conf(10**6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
