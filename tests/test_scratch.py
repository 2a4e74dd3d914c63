import os

import pytest

from grafloom import scratch


def test_tables_are_written_read_and_discarded(spark):
    a, b = scratch.materialise(spark.range(5), "a"), scratch.materialise(spark.range(3), "b")
    folder = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    gone, left = folder(a), folder(b)
    assert os.path.exists(gone) and a.count() == 5
    scratch.discard(a)
    assert not os.path.exists(gone) and os.path.exists(left) and b.count() == 3


def test_only_intermediate_tables_are_discarded(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "mine"))
    with pytest.raises(ValueError):
        scratch.discard(spark.read.parquet(str(tmp_path / "mine")))
    assert spark.read.parquet(str(tmp_path / "mine")).count() == 2


def test_a_cluster_must_name_a_shared_folder():
    """Also local-cluster, whose executors are processes of their own."""

    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})()
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]", "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Fake())


def test_partitions_follow_the_bytes(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert scratch.parts_for(df) == 8 and scratch.parts_for(df, 100) > 50 and scratch.parts_for(df, 0 + 1) <= 100_000
