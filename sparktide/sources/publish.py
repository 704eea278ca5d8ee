"""Put new table content in place of old: all of it or none.

The new content is written beside the table and checked; only then are the
two folders exchanged by rename. The path being read is never overwritten.
Rename is atomic on HDFS and local disks. On object stores keep the table in
a catalog and use ``publish_location``, which moves one metastore pointer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktide.workspace import Files, materialise


class PublishAborted(Exception):
    """The staged content failed its check; the table is as it was."""


def _beside(path: str, label: str) -> str:
    return f"{path.rstrip('/')}.{label}"


def stage_and_publish(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame], bool] | None = None,
    partition_by: Sequence[str] = (),
    compact: bool = False,
) -> DataFrame:
    """Stage ``df``, check it, exchange it with the table at ``path``; returns a new scan.

    When ``check`` says no, or the write fails, the staged files are dropped
    and the table is untouched (the rollback case). ``compact`` shuffles few
    remaining rows into files of normal size, for a change that drops most of
    the table.
    """
    spark = df.sparkSession
    files = Files(spark, path)
    restore(spark, path)
    staging, previous = _beside(path, f"staging-{uuid.uuid4().hex}"), _beside(path, "previous")
    if compact:
        df = df.hint("rebalance", *partition_by)
    try:
        df.write.partitionBy(*partition_by).parquet(staging)
        if check is not None and not check(spark.read.schema(df.schema).parquet(staging)):
            raise PublishAborted(path)
    except Exception:
        files.delete(staging)
        raise
    if files.exists(path):
        files.rename(path, previous)
    files.rename(staging, path)
    files.delete(previous)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    restore(spark, path)
    return Files(spark, path).exists(path)


def restore(spark: SparkSession, path: str) -> None:
    """Finish or undo an exchange that a crash interrupted between its two renames."""
    files = Files(spark, path)
    previous = _beside(path, "previous")
    if files.exists(previous):
        if files.exists(path):
            files.delete(previous)
        else:
            files.rename(previous, path)


def change_table(
    spark: SparkSession,
    path: str,
    change: Callable[[DataFrame], DataFrame],
    check: Callable[[DataFrame], bool] | None = None,
    partition_by: Sequence[str] = (),
    compact: bool = False,
) -> DataFrame:
    """Read the table, apply ``change``, publish the result."""
    restore(spark, path)
    return stage_and_publish(change(spark.read.parquet(path)), path, check, partition_by, compact)


def change_partitions(
    spark: SparkSession,
    path: str,
    partition: str,
    predicate: Column,
    change: Callable[[DataFrame], DataFrame],
) -> None:
    """Apply ``change`` to the partitions that hold a row of ``predicate``; leave the others.

    A touched partition is replaced by what ``change`` keeps of it, which must
    stay in that partition. Reads and writes grow with the touched partitions,
    not with the table; the join with the touched values prunes the scan while
    the query runs. A null partition value is a partition like any other. The
    changed rows are written aside before anything is exchanged; each partition
    is then exchanged on its own, so a call that failed may be repeated if the
    change gives the same rows when applied twice.
    """
    table = spark.read.parquet(path)
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    touched = materialise(
        table.where(predicate).select(partition, folder.alias("_folder")).distinct(), "touched"
    )
    named = touched.where(F.col(partition).isNotNull()).select(partition)
    given = table.join(named, partition, "left_semi")
    if not touched.where(F.col(partition).isNull()).isEmpty():
        given = given.unionByName(table.where(F.col(partition).isNull()))
    part = materialise(change(given).select(*table.columns), "changed")
    # A partition without remaining rows is not overwritten but removed; at
    # most one row per partition of the table comes to the driver.
    kept = part.select(F.col(partition).alias("_kept")).distinct()
    gone = touched.join(kept, F.col(partition).eqNullSafe(F.col("_kept")), "left_anti")
    emptied = [r["_folder"] for r in gone.select("_folder").collect()]
    (
        part.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    files = Files(spark, path)
    for uri in emptied:
        files.delete_uri(uri)
    spark.catalog.refreshByPath(path)


def truncate(spark: SparkSession, path: str) -> DataFrame:
    """No rows, same schema."""
    return change_table(spark, path, lambda df: df.limit(0))


def publish_location(df: DataFrame, table: str, path: str) -> None:
    """Write ``df`` to the unused ``path`` and point the catalog table at it."""
    spark = df.sparkSession
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path, source="parquet")
