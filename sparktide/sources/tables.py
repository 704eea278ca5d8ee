"""Scans, generated rows, appends and clustered layouts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktide.operators import ordering
from sparktide.sources import publish


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def generate_rows(spark: SparkSession, n: int, start: int = 1, ts: dt.datetime | None = None) -> DataFrame:
    """Ids ``start`` to ``start + n - 1`` with one load time, as one distributed range."""
    loaded = F.lit(ts).cast("timestamp_ntz")
    return spark.range(start, start + n).select("id", loaded.alias("update_date"))


def append_select(
    src: DataFrame,
    target: str,
    cols: Sequence[str],
    limit: int | None = None,
    order_by: str | None = None,
) -> None:
    """Append chosen columns of ``src`` to the table at ``target``.

    With ``limit`` the first rows by ``order_by`` are taken; without an order,
    any rows.
    """
    rows = src.select(*cols)
    if limit is not None:
        rows = ordering.first_rows(rows, order_by, limit) if order_by else rows.limit(limit)
    rows.write.mode("append").parquet(target)


def append_values(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """``df`` with literal rows added; the rows are written in column order."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def copy_retyped(
    df: DataFrame,
    types: Mapping[str, str],
    limit: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """A copy with some columns converted; ``varchar(n)`` also cuts to n characters.

    With ``limit`` only the rows with the smallest ``key`` are copied.
    """
    if limit is not None:
        df = ordering.first_rows(df, key, limit) if key else df.limit(limit)
    changed = {}
    for col, kind in types.items():
        if kind.startswith("varchar("):
            width = int(kind[len("varchar(") : -1])
            changed[col] = F.left(F.col(col).cast("string"), F.lit(width))
        else:
            changed[col] = F.col(col).cast(kind)
    return df.withColumns(changed)


def with_constant_text(df: DataFrame, text: str, n: int, name: str = "some_text") -> DataFrame:
    """A filler column: ``text`` repeated ``n`` times."""
    return df.withColumn(name, F.repeat(F.lit(text), n))


def write_clustered(df: DataFrame, key: str, path: str) -> None:
    """Write files that each hold a range of ``key``, sorted, so scans skip row groups.

    A row number is part of the range key: a key value with very many rows is
    spread over several files instead of one task.
    """
    (
        df.withColumn("_spread", F.monotonically_increasing_id())
        .repartitionByRange(key, "_spread")
        .sortWithinPartitions(key)
        .drop("_spread")
        .write.parquet(path)
    )


def drop_and_create(spark: SparkSession, path: str, schema) -> None:
    """An empty table of ``schema`` in place of whatever was there."""
    publish.stage_and_publish(spark.createDataFrame([], schema), path)
