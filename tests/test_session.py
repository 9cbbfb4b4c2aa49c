import os

from strata.session import new_work_path, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = new_work_path(spark, "x"), new_work_path(spark, "x")
    assert a != b and a.startswith(root + "/strata/x/") and os.path.isdir(a)
    assert spark.sparkContext.getCheckpointDir() is not None
