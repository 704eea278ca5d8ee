"""Intermediate tables in the folder every executor can reach.

Lineage is cut by writing Parquet there and reading it back, so a lost
executor costs the tasks that ran on it and nothing that was already written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or a fresh local one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="sparktide-")
    spark.sparkContext.setCheckpointDir(root)
    return root


class Files:
    """The few file-system calls the library needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._uri = spark._jvm.java.net.URI
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, src: str, dst: str) -> None:
        if not self._fs.rename(self._path(src), self._path(dst)):
            raise OSError(f"cannot rename {src} to {dst}")

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def delete_uri(self, uri: str) -> None:
        """Delete a folder named by an encoded URI, as scans report it."""
        if not self._fs.delete(self._path(self._uri(uri)), True):
            raise OSError(f"cannot delete {uri}")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/sparktide/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{label}"


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames over them end with it."""
    Files(spark, shared_root(spark)).delete(_own_folder(spark))


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of the written table (runs a job)."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
