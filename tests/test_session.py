"""Shared folder for written tables: taken from the session's checkpoint
setting, unique per call unless asked otherwise."""

from tripmart.session import path_exists, shared_path, shared_root


def test_shared_root_is_the_checkpoint_dir(spark):
    root = shared_root(spark)
    ckpt = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    assert root == ckpt.rstrip("/")


def test_shared_paths(spark):
    a, b = shared_path(spark, "x", "y"), shared_path(spark, "x", "y")
    assert a != b and a.startswith(shared_root(spark)) and "/tripmart/x/y/" in a
    fixed = shared_path(spark, "x", "z", unique=False)
    assert fixed == shared_path(spark, "x", "z", unique=False)
    assert not path_exists(spark, a)
    spark.range(3).write.parquet(a)
    assert path_exists(spark, a) and path_exists(spark, a + "/_SUCCESS")
