"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in local mode a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="grafloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the application ends."""
    path = f"{shared_dir(spark)}/grafloom/{name}-{uuid.uuid4().hex}"
    store, at = _file_system(spark, path)
    if not store.exists(at.getParent()):
        store.mkdirs(at.getParent())
    store.mkdirs(at)  # only paths that exist can be marked
    store.deleteOnExit(at)
    store.delete(at, True)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which cuts its lineage: a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the table that `materialise` returned as df; nothing may read it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/grafloom/" not in path:
            raise ValueError(f"{path} is not an intermediate table")
        store, at = _file_system(df.sparkSession, path)
        store.delete(at, True)


def parts_for(df: DataFrame, bytes_a_part: int = 256 << 20) -> int:
    """Partitions for a sort or a range partitioning of df: spark.sql.shuffle.partitions, or more if Spark's estimate of its bytes asks for it."""
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # estimates of joins can be far off: never more than 100,000
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(100_000, -(-estimate // bytes_a_part)))
