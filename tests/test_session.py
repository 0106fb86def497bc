"""Scratch outputs and written stages live under the session's checkpoint directory."""

import pytest

from tierlake.session import ensure_checkpoint_dir, materialize, scratch_path


def test_scratch_paths_follow_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and root == spark.sparkContext.getCheckpointDir()
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(root) and p2.startswith(root) and p1 != p2


def test_materialized_stage_is_read_from_the_shared_root(spark):
    root = ensure_checkpoint_dir(spark)
    df = spark.range(100).withColumnRenamed("id", "k")
    out = materialize(df, "probe")
    assert out.count() == 100
    def norm(uri):
        return uri.replace("file:///", "/").replace("file:/", "/")
    files = out.inputFiles()
    assert files and all(norm(f).startswith(norm(root)) for f in files)


class _Cluster:
    """A session of another master without a checkpoint folder."""

    def __init__(self, master):
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_path(_Cluster(master), "x")
