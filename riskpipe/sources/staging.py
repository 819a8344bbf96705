"""Intermediate tables in the cluster's shared folder.

Multi-pass jobs write their input once as Parquet and read it back.  Unlike a cached or
checkpointed frame, a Parquet table is column-pruned by every later pass, and unlike a cache it
outlives the executors that wrote it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _new_path(spark: SparkSession):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/riskpipe/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A new path below ``spark.checkpoint.dir``, deleted with all that is in it at the end."""
    path, folder, files = _new_path(spark)
    files.mkdirs(folder)
    files.deleteOnExit(folder)  # also where the driver stops halfway
    try:
        yield path
    finally:
        files.delete(folder, True)


def staging_dir(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir`` for a result, deleted when the application ends."""
    path, folder, files = _new_path(spark)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table or folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, folder: str | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` to a table and return the frame that reads it.

    The table lies in ``folder``, which its owner deletes, or else until the application ends.
    """
    spark = df.sparkSession
    path = f"{folder or staging_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
