"""Queries of the event-capture family: each runs as a stream and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktide.operators import antipatterns
from sparktide.plans.registry import query
from sparktide.plans.views import Tables
from sparktide.streaming import captures, sinks
from sparktide.workspace import new_path

_BASE = "event_id, ts, session_id, event_name"
_CLIENT = "client_app_name, client_hostname, username"
_DATABASE = "database_id, database_name"
_PLAN = "client_app_name, plan_handle, query_hash, query_plan_hash"
_LOCK = "blocked_process, index_id, lock_mode, object_id, resource_owner_type, transaction_id"

# Per capture: the survey rows, the columns and the condition of its SQL, and its rule.
_CAPTURES = {
    "long_running": (
        "ST-01 S-11", f"duration_us, {_PLAN}, {_DATABASE}, sql_text", "duration_us >= 1000000", captures.long_running_rule
    ),
    "failed_queries": (
        "ST-02", f"severity, {_CLIENT}, {_DATABASE}, sql_text", "event_name = 'error' AND severity > 10",
        lambda: captures.failed_queries_rule(names=["error"]),
    ),
    "aborted_queries": ("ST-03", f"result, {_DATABASE}, sql_text", "result = 'Abort'", captures.aborted_queries_rule),
    "abort_events": (
        "ST-03", f"result, {_DATABASE}, sql_text", "result = 'Abort' OR event_name = 'error'",
        lambda: captures.aborted_queries_rule(["error"]),
    ),
    "antipattern_events": (
        "ST-04", f"{_PLAN}, sql_text", "event_name = 'click' AND client_app_name <> 'app_1' AND client_app_name <> 'app_2'",
        lambda: captures.antipattern_events_rule(["app_1", "app_2"], names=["click"]),
    ),
    "spills": ("ST-05", f"spills, {_DATABASE}, {_CLIENT}, tsql_stack, sql_text", "spills > 0", captures.spills_rule),
    "spill_events": (
        "ST-05", f"spills, {_DATABASE}, {_CLIENT}, tsql_stack, sql_text", "spills > 0 OR event_name = 'view'",
        lambda: captures.spills_rule(["view"]),
    ),
    "tempdb_growth": (
        "ST-06", f"{_DATABASE}, client_hostname, sql_text",
        "event_name IN ('click', 'purchase') AND database_id = 2 AND session_id > 50",
        lambda: captures.tempdb_growth_rule(["click", "purchase"]),
    ),
    "blocked_process": (
        "ST-07 S-11", f"duration_us, {_DATABASE}, {_LOCK}", "event_name = 'purchase'",
        lambda: captures.blocked_process_rule(["purchase"]),
    ),
    "deadlocks": (
        "ST-08", "client_app_name, sql_text", "event_name IN ('error', 'signup')",
        lambda: captures.deadlocks_rule(["error", "signup"]),
    ),
}


def _stream(t):
    return Tables.as_xe_events(sinks.event_stream(t.spark, t.folder, "events", t.events.schema))


def _register(name: str, covers: str, columns: str, condition: str, rule) -> None:
    @query(f"capture_{name}", covers, f"SELECT {_BASE}, {columns} FROM xe_events WHERE {condition}", views="xe_events")
    def _(t):
        return sinks.captured(captures.capture(_stream(t), rule()), name)


for _name, _parts in _CAPTURES.items():
    _register(_name, *_parts)

_ALL_COLUMNS = list(dict.fromkeys(c for _, columns, *_ in _CAPTURES.values() for c in columns.split(", ")))


def _one_of_all(name: str, columns: str, condition: str) -> str:
    kept = ", ".join(c if c in columns.split(", ") else f"NULL AS {c}" for c in _ALL_COLUMNS)
    return f"SELECT '{name}' AS capture, {_BASE}, {kept} FROM xe_events WHERE {condition}"


@query(
    "capture_fan_out",
    "ST-01 ST-02 ST-03 ST-04 ST-05 ST-06 ST-07 ST-08 S-11",
    " UNION ALL BY NAME ".join(_one_of_all(name, columns, condition) for name, (_, columns, condition, _) in _CAPTURES.items()),
    views="xe_events",
)
def _(t):
    rules = {name: rule() for name, (*_, rule) in _CAPTURES.items()}
    return sinks.captured(captures.fan_out(_stream(t), rules), "fan_out", "capture")


@query(
    "antipattern_scan",
    "ST-09",
    """SELECT query_id, col AS compared_column, 1 AS type_convert,
              CASE WHEN n_terms >= 65 THEN 1 ELSE 0 END AS large_number_of_or
       FROM query_log WHERE (col = 'views' AND literal = 'number')
                         OR (col = 'display_name' AND literal IN ('number', 'national'))""",
    views="query_log",
)
def _(t):
    return antipatterns.antipattern_scan(t.query_log, t.column_types)


@query(
    "event_rate",
    "ST-10",
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_name,
              count(*) AS n_events
       FROM xe_events GROUP BY date_trunc('day', ts), event_name""",
    views="xe_events",
)
def _(t):
    zoned = _stream(t).withColumn("ts", F.col("ts").cast("timestamp"))
    emitted = sinks.captured(captures.event_rate(zoned, "1 day", "1 hour"), "event_rate")
    batch = t.xe_events.withColumn("ts", F.col("ts").cast("timestamp"))
    rate = emitted.union(captures.open_windows(batch, "1 day", "1 hour"))
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return rate.withColumns(plain)


_RECENT_SQL = """SELECT event_id, ts, session_id, event_name FROM (
         SELECT *, row_number() OVER (PARTITION BY event_name ORDER BY ts DESC, event_id DESC) AS r
         FROM xe_events) s WHERE r <= {n}"""
_RECENT_COLUMNS = ["event_id", "ts", "session_id", "event_name"]


def _latest_first():
    return [F.desc("ts"), F.desc("event_id")]


@query("recent_events", "S-12", _RECENT_SQL.format(n=50), views="xe_events")
def _(t):
    return sinks.recent_events(t.xe_events.select(*_RECENT_COLUMNS), 50, _latest_first(), "event_name")


@query("recent_events_many", "S-12", _RECENT_SQL.format(n=1500), views="xe_events")
def _(t):
    return sinks.recent_events(t.xe_events.select(*_RECENT_COLUMNS), 1500, _latest_first(), "event_name")


@query("ring_buffer_stream", "S-12", _RECENT_SQL.format(n=20), views="xe_events")
def _(t):
    path = new_path(t.spark, "ring")
    stream = _stream(t).select(*_RECENT_COLUMNS)
    held = 20, ["ts", "event_id"], "event_name"
    sinks.ring_buffer(stream, *held, path).awaitTermination()
    return sinks.read_ring_buffer(t.spark, path, stream.schema, *held)
