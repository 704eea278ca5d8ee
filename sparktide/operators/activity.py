"""Analysis of activity snapshots: one row per session and collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktide.functions import conversion, temporal
from sparktide.operators import slices
from sparktide.workspace import materialise

def _day() -> Column:
    return F.to_date("collection_time")


def _latest(snap: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows of each session's last collection: a hashed maximum and a join back, so no session is sorted."""
    last = snap.groupBy("session_id").agg(F.max("collection_time").alias("collection_time"))
    rows = snap.select("session_id", "collection_time", *cols)
    return rows.join(materialise(last, "last_collections"), ["session_id", "collection_time"], "left_semi")


def tempdb_usage(snap: DataFrame) -> DataFrame:
    """Current scratch-space allocation of each session, largest first."""
    latest = _latest(snap, ["login_name", "start_time", "wait_info", "tempdb_current"])
    return latest.orderBy(F.desc("tempdb_current"), "session_id")


def memory_usage(snap: DataFrame, measure: str) -> DataFrame:
    """Latest value of another measure of each session, largest first."""
    latest = _latest(snap, ["login_name", "start_time", measure])
    return latest.orderBy(F.desc(measure), "session_id")


def activity_delta(snap: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Change of each counter since the session's previous collection, as ``<measure>_delta``.

    Null on a session's first collection.
    """
    before = {f"_{m}": m for m in measures}
    rows = slices.neighbour(snap, ["session_id"], ["collection_time"], before, _day())
    deltas = {f"{m}_delta": F.col(m) - F.col(f"_{m}") for m in measures}
    return rows.withColumns(deltas).drop(*before)


def tempdb_delta_top(snap: DataFrame) -> DataFrame:
    """Change of each session's scratch space between collections, largest first."""
    grown = activity_delta(snap, ["tempdb_current"]).where(F.col("tempdb_current_delta").isNotNull())
    return (
        grown.select("collection_time", "session_id", "tempdb_current", "tempdb_current_delta")
        .orderBy(F.desc("tempdb_current_delta"), "collection_time", "session_id")
    )


def wait_profile(snap: DataFrame) -> DataFrame:
    """How often each session was seen in each wait, one row per pair."""
    return (
        snap.where(F.col("wait_info").isNotNull())
        .groupBy("session_id", "wait_info")
        .agg(
            F.count("*").alias("times_seen"),
            F.min("collection_time").alias("first_seen"),
            F.max("collection_time").alias("last_seen"),
        )
    )


def average_time_baseline(history: DataFrame, current: DataFrame, key: str, time: str) -> DataFrame:
    """Current runs beside the average of earlier ones; ``is_slower`` is 1 above it.

    The averages, one row per key, are written first (a job): their exact size
    decides whether they are broadcast, and otherwise AQE can split a key of
    very many current runs, which it cannot against an unwritten aggregate.
    """
    usual = materialise(
        history.groupBy(key).agg(
            F.count(time).alias("usual_runs"),
            conversion.rounded_mean(conversion.wide_sum(time), F.count(time)).alias("usual_time"),
        ),
        "usual",
    )
    slower = F.when(F.col(time) > F.col("usual_time"), 1).when(F.col("usual_time").isNotNull(), 0)
    return current.join(usual, key, "left").withColumn("is_slower", slower)


def parameter_sensitivity(stats: DataFrame, key: str, time: str, percent: int) -> DataFrame:
    """Queries whose slowest run took at least ``percent`` of the average run.

    A wide spread of one query's times points at a plan built for other
    parameter values.
    """
    total, runs = conversion.wide_sum(time), F.count(time)
    slowest = F.max(time).cast("decimal(19,0)") * 100
    return (
        stats.groupBy(key)
        .agg(
            runs.alias("runs"),
            F.min(time).alias("min_time"),
            F.max(time).alias("max_time"),
            conversion.rounded_mean(total, runs).alias("avg_time"),
            conversion.whole_division(slowest * runs.cast("decimal(15,0)"), F.nullif(total, F.lit(0))).alias(
                "slowest_percent"
            ),
        )
        .where(F.col("slowest_percent") >= percent)
    )


def blocked_sessions(
    events: DataFrame, is_lock: Column, threshold_s: int = 5, slice_by: Column | None = None
) -> DataFrame:
    """Lock waits of at least ``threshold_s`` seconds.

    A wait starts at an event matched by ``is_lock`` and ends at the session's
    next event; a wait still open at the end of the log is not reported. All
    columns of the starting event are kept. ``slice_by`` is the time slice in
    which a session is sorted by one task, an hour by default.
    """
    ended = slices.neighbour(
        events.withColumn("_lock", is_lock),
        ["session_id"],
        ["ts", "event_id"],
        {"lock_end": "ts"},
        F.date_trunc("hour", "ts") if slice_by is None else slice_by,
        ahead=True,
    )
    waited = temporal.micros_between(F.col("ts"), F.col("lock_end"))
    return (
        ended.where(F.col("_lock"))
        .withColumn("waited_us", waited)
        .where(F.col("waited_us") >= threshold_s * 1_000_000)
        .withColumnRenamed("ts", "lock_start")
        .drop("_lock")
    )


def snapshot_blockers(
    snap: DataFrame, lo, hi, exclude_logins: Sequence[str], lead: bool = False
) -> DataFrame:
    """Blocker beside blocked within one collection, columns prefixed.

    As written in the monitoring practice it comes from, the blocker waits on
    a lock and the blocked session on something else; ``lead`` swaps the two
    wait filters, which finds the heads of chains. A null wait matches neither.
    """
    kind = snap.schema["collection_time"].dataType
    window = snap.where(F.col("collection_time").between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
    on_lock = F.col("wait_info").like("%LCK%")
    blocker_wait, blocked_wait = (~on_lock, on_lock) if lead else (on_lock, ~on_lock)
    blocker = window.where(~F.col("login_name").isin(list(exclude_logins)) & blocker_wait)
    blocked = window.where(blocked_wait)

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])

    left, right = prefixed(blocker, "blocker"), prefixed(blocked, "blocked")
    same_time = F.col("blocker_collection_time") == F.col("blocked_collection_time")
    # A row without a blocker doesn't go through the exchange ...
    known = right.where(F.col("blocked_blocking_session_id").isNotNull())
    met = left.join(known, (F.col("blocker_session_id") == F.col("blocked_blocking_session_id")) & same_time, "inner")
    # ... unless there is a session 0, which such a row stands beside.
    zero = left.where(F.col("blocker_session_id") == 0)
    if not zero.isEmpty():
        met = met.union(zero.join(right.where(F.col("blocked_blocking_session_id").isNull()), same_time, "inner"))
    return met.orderBy("blocker_collection_time", "blocker_session_id", "blocked_session_id")
