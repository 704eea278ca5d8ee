"""A growing table of activity snapshots, partitioned by collection date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PARTITION = "collection_date"
BATCH = "batch_id"
BEFORE_ALL = "1970-01-01"
TABLE_MARK = "<table_name>"


# Dates that the time zones of a writer and a reader can put between them.
ZONE_DAYS = 2


def schema_template(df: DataFrame) -> str:
    """DDL of the snapshot with a mark where the table name goes."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return f"CREATE TABLE {TABLE_MARK} ({columns})"


def schema_ddl(df: DataFrame, table: str) -> str:
    return schema_template(df).replace(TABLE_MARK, table)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION, F.to_date("collection_time"))


def _by_date(df: DataFrame) -> DataFrame:
    """Few files per date: small dates share a task, a large one is split over several."""
    return _dated(df).hint("rebalance", PARTITION)


def create_snapshot_table(df: DataFrame, path: str) -> None:
    """An empty snapshot table with the columns of ``df``.

    A partitioned write of no rows leaves no file, so the schema is kept by an
    empty file under a date before any snapshot.
    """
    df.limit(0).write.parquet(f"{path}/{PARTITION}={BEFORE_ALL}")


def append_snapshot(df: DataFrame, path: str, collection_time: dt.datetime | None = None) -> None:
    """Add one snapshot; a wider one may bring new columns.

    Without ``collection_time`` the rows carry their own.
    """
    if collection_time is not None:
        df = df.withColumn("collection_time", F.lit(collection_time).cast("timestamp_ntz"))
    _by_date(df).write.partitionBy(PARTITION).mode("append").parquet(path)


def read_snapshots(spark: SparkSession, path: str, lo=None, hi=None, schema=None) -> DataFrame:
    """Snapshots of a closed time window; dates far from it are not opened.

    A date was cut in the writer's time zone and zones are up to 26 hours apart,
    so two more dates on each side are read and the time decides.

    Without ``schema`` the columns of all files are merged, which reads every
    footer; name the schema on a table of many files.
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    snap = reader.parquet(path)
    date, time = F.col(PARTITION), F.col("collection_time")
    kind = snap.schema["collection_time"].dataType
    if lo is not None:
        snap = snap.where((date >= F.date_sub(F.lit(lo).cast("date"), ZONE_DAYS)) & (time >= F.lit(lo).cast(kind)))
    if hi is not None:
        snap = snap.where((date <= F.date_add(F.lit(hi).cast("date"), ZONE_DAYS)) & (time <= F.lit(hi).cast(kind)))
    return snap.drop(PARTITION, BATCH)


def collect_snapshots(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch of a snapshot stream; a replayed batch is written once.

    Each batch has its own folder, overwritten on replay, below the table root.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            _by_date(batch)
            .write.partitionBy(PARTITION)
            .mode("overwrite")
            .parquet(f"{path}/{BATCH}={batch_id}")
        )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
