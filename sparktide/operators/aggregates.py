"""Aggregations. All are partial on the map side, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.functions import conversion


def count_column(df: DataFrame, col: str) -> DataFrame:
    """Non-null values."""
    return df.agg(F.count(col).alias("n"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def select_distinct(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def log_summary(log: DataFrame) -> DataFrame:
    """Number of change records and of the locks they took."""
    return log.agg(
        F.count("lsn").alias("log_records"),
        F.coalesce(F.sum(F.coalesce("n_locks", F.lit(0))), F.lit(0)).alias("locks"),
    )


def transaction_log_usage(log: DataFrame) -> DataFrame:
    """Change records, modifying records and locks of each transaction, largest first.

    ``is_open`` is 1 where the last begin has no commit after it.
    """
    changed = F.col("operation") == "LOP_MODIFY_ROW"
    begun = F.max(F.when(F.col("operation") == "LOP_BEGIN_XACT", F.col("lsn")))
    committed = F.max(F.when(F.col("operation") == "LOP_COMMIT_XACT", F.col("lsn")))
    return (
        log.groupBy("transaction_id")
        .agg(
            F.count("*").alias("log_records"),
            F.count_if(changed).alias("row_changes"),
            F.sum(F.coalesce("n_locks", F.lit(0))).alias("locks"),
            F.min("lsn").alias("first_lsn"),
            F.max("lsn").alias("last_lsn"),
            F.when((begun > committed) | (begun.isNotNull() & committed.isNull()), 1).otherwise(0).alias("is_open"),
        )
        .orderBy(F.desc("log_records"), "transaction_id")
    )


# The record kinds a single-row change writes, in log order.
LOG_OPERATIONS = ("LOP_BEGIN_XACT", "LOP_MODIFY_ROW", "LOP_COMMIT_XACT")


def log_by_operation(log: DataFrame) -> DataFrame:
    return log.groupBy("operation").agg(F.count("*").alias("records"))


def log_by_transaction_and_operation(log: DataFrame) -> DataFrame:
    """One row per transaction, one column per record kind."""
    counts = log.groupBy("transaction_id").pivot("operation", list(LOG_OPERATIONS)).count()
    return counts.na.fill(0, list(LOG_OPERATIONS))


def lock_profile(log: DataFrame) -> DataFrame:
    """Records of each transaction per number of locks they took."""
    return (
        log.where(F.col("n_locks").isNotNull())
        .groupBy("transaction_id", "n_locks")
        .agg(F.count("*").alias("records"))
    )


def event_fire_stats(events: DataFrame, keys: Sequence[str] = ("session_id", "event_name")) -> DataFrame:
    """Count and mean, least and greatest time of each event in each session.

    The mean is rounded to whole microseconds in integer arithmetic.
    """
    return events.groupBy(*keys).agg(
        F.count("*").alias("event_fire_count"),
        conversion.rounded_mean(conversion.wide_sum("duration_us"), F.count("duration_us")).alias(
            "event_fire_average_time"
        ),
        F.min("duration_us").alias("event_fire_min_time"),
        F.max("duration_us").alias("event_fire_max_time"),
    )


def event_cost(sessions: DataFrame, fire_stats: DataFrame) -> DataFrame:
    """Session names beside the cost of their events, most frequent first."""
    return (
        sessions.join(fire_stats, "session_id", "inner")
        .select(
            "session_name",
            "event_name",
            "event_fire_count",
            "event_fire_average_time",
            "event_fire_min_time",
            "event_fire_max_time",
        )
        .orderBy(F.desc("event_fire_count"), "session_name", "event_name")
    )
