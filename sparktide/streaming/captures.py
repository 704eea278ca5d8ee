"""Event captures: a predicate per event kind and the columns kept with it.

Each capture works on a stream and on a batch alike. A capture is a filter
and a projection, so it keeps no state and scales with the source. ``fan_out``
applies any number of captures in one pass over the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the captures; fixed values.
LONG_RUNNING_US = 1_000_000
REPORTED_SEVERITY = 10
TEMPDB_ID = 2
LAST_SYSTEM_SESSION = 50

# Columns a capture keeps besides its own; fixed names.
BASE = ("event_id", "ts", "session_id", "event_name")
CLIENT = ("client_app_name", "client_hostname", "username")
DATABASE = ("database_id", "database_name")
PLAN = ("client_app_name", "plan_handle", "query_hash", "query_plan_hash")
LOCK = ("blocked_process", "index_id", "lock_mode", "object_id", "resource_owner_type", "transaction_id")


@dataclass(frozen=True)
class Capture:
    """Which events are captured, and what is kept of them besides ``BASE``."""

    hit: Column
    columns: tuple[str, ...]


def _of_kind(names: Sequence[str] | None) -> Column:
    return F.lit(True) if names is None else F.col("event_name").isin(list(names))


def long_running_rule(min_us: int = LONG_RUNNING_US, names=None) -> Capture:
    """Completed statements that took at least ``min_us`` microseconds."""
    return Capture(_of_kind(names) & (F.col("duration_us") >= min_us), ("duration_us", *PLAN, *DATABASE, "sql_text"))


def failed_queries_rule(min_severity: int = REPORTED_SEVERITY, names=None) -> Capture:
    """Errors above a severity."""
    return Capture(_of_kind(names) & (F.col("severity") > min_severity), ("severity", *CLIENT, *DATABASE, "sql_text"))


def aborted_queries_rule(abort_events: Sequence[str] = ()) -> Capture:
    """Events that are aborts by kind, or batches that ended in one."""
    aborted = F.col("result") == "Abort"
    if abort_events:
        aborted = aborted | F.col("event_name").isin(list(abort_events))
    return Capture(aborted, ("result", *DATABASE, "sql_text"))


def antipattern_events_rule(exclude_apps: Sequence[str], names=None) -> Capture:
    """Antipattern events, except those of the named client programs."""
    hit = reduce(lambda kept, app: kept & (F.col("client_app_name") != app), exclude_apps, _of_kind(names))
    return Capture(hit, (*PLAN, "sql_text"))


def spills_rule(spill_events: Sequence[str] = ()) -> Capture:
    """Spill events by kind, or statements that spilled at least once."""
    spilled = F.col("spills") > 0
    if spill_events:
        spilled = spilled | F.col("event_name").isin(list(spill_events))
    return Capture(spilled, ("spills", *DATABASE, *CLIENT, "tsql_stack", "sql_text"))


def tempdb_growth_rule(
    growth_events: Sequence[str] | None, database_id: int = TEMPDB_ID, above_session: int = LAST_SYSTEM_SESSION
) -> Capture:
    """Size changes of the scratch database caused by user sessions."""
    hit = _of_kind(growth_events) & (F.col("database_id") == database_id) & (F.col("session_id") > above_session)
    return Capture(hit, (*DATABASE, "client_hostname", "sql_text"))


def blocked_process_rule(report_events: Sequence[str]) -> Capture:
    """Blocked-process reports with their duration."""
    return Capture(_of_kind(report_events), ("duration_us", *DATABASE, *LOCK))


def deadlocks_rule(deadlock_events: Sequence[str]) -> Capture:
    """Deadlock and deadlock-chain events."""
    return Capture(_of_kind(deadlock_events), ("client_app_name", "sql_text"))


def _require(events: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in events.columns]
    if missing:
        raise ValueError(f"the events lack {', '.join(missing)}")


def capture(events: DataFrame, rule: Capture) -> DataFrame:
    """The captured events with the columns kept of them; a missing column is an error."""
    wanted = [*BASE, *rule.columns]
    _require(events, wanted)
    return events.where(rule.hit).select(*wanted)


def fan_out(events: DataFrame, rules: Mapping[str, Capture]) -> DataFrame:
    """All captures in one pass: a row per event and capture that keeps it, named by ``capture``.

    The columns are those of all captures; what a capture doesn't keep is null. Written
    with ``capture`` as the partition column, each target is a folder of its own.
    """
    extra = list(dict.fromkeys(c for rule in rules.values() for c in rule.columns))
    _require(events, [*BASE, *extra])
    hits = F.array_compact(F.array(*[F.when(rule.hit, name) for name, rule in rules.items()]))
    dealt = events.withColumn("capture", F.explode(hits))

    def kept(column: str) -> Column:
        keepers = [name for name, rule in rules.items() if column in rule.columns]
        return F.col(column) if len(keepers) == len(rules) else F.when(F.col("capture").isin(keepers), F.col(column))

    return dealt.select("capture", *BASE, *[kept(c).alias(c) for c in extra])


def long_running(events: DataFrame, min_us: int = LONG_RUNNING_US, names=None) -> DataFrame:
    return capture(events, long_running_rule(min_us, names))


def failed_queries(events: DataFrame, min_severity: int = REPORTED_SEVERITY, names=None) -> DataFrame:
    return capture(events, failed_queries_rule(min_severity, names))


def aborted_queries(events: DataFrame, abort_events: Sequence[str] = ()) -> DataFrame:
    return capture(events, aborted_queries_rule(abort_events))


def antipattern_events(events: DataFrame, exclude_apps: Sequence[str], names=None) -> DataFrame:
    return capture(events, antipattern_events_rule(exclude_apps, names))


def spills(events: DataFrame, spill_events: Sequence[str] = ()) -> DataFrame:
    return capture(events, spills_rule(spill_events))


def tempdb_growth(events: DataFrame, growth_events: Sequence[str] | None, **limits) -> DataFrame:
    return capture(events, tempdb_growth_rule(growth_events, **limits))


def blocked_process(events: DataFrame, report_events: Sequence[str]) -> DataFrame:
    return capture(events, blocked_process_rule(report_events))


def deadlocks(events: DataFrame, deadlock_events: Sequence[str]) -> DataFrame:
    return capture(events, deadlocks_rule(deadlock_events))


def _counted(events: DataFrame, window: str, keys: Sequence[str]) -> DataFrame:
    counted = events.groupBy(F.window("ts", window), *keys).agg(F.count("*").alias("n_events"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n_events"
    )


def event_rate(
    stream: DataFrame, window: str, watermark: str, keys: Sequence[str] = ("event_name",)
) -> DataFrame:
    """Events per window and key. ``ts`` must be a zoned timestamp for the watermark.

    In append mode a window is emitted once the watermark passes its end. The
    state holds one counter per open window and key.
    """
    return _counted(stream.withWatermark("ts", watermark), window, keys)


def open_windows(
    events: DataFrame, window: str, watermark: str, keys: Sequence[str] = ("event_name",)
) -> DataFrame:
    """The windows that ``event_rate`` still holds after a bounded run over ``events``, a batch.

    With those that were emitted they are all windows. Only events of the last windows are
    read: the watermark is one aggregate of the source. Without events there are none.
    """
    delay = F.expr(f"INTERVAL {watermark}")
    passed = events.agg((F.max("ts") - delay).alias("passed"))
    bounds = passed.where("passed IS NOT NULL").select("passed", F.window("passed", window)["start"].alias("begun")).first()
    if bounds is None:
        return _counted(events, window, keys)
    late = _counted(events.where(F.col("ts") >= F.lit(bounds.begun)), window, keys)
    return late.where(F.col("window_end") > F.lit(bounds.passed))
