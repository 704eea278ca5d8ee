"""Queries of the aggregation and window families."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparktide.operators import activity, aggregates, blocking
from sparktide.plans.registry import query

BASELINE_END = dt.datetime(2024, 1, 20)


@query(
    "count_column", "A-01", "SELECT count(ship_date) AS n FROM orders_nullable", views="orders_nullable"
)
def _(t):
    return aggregates.count_column(t.orders_nullable, "ship_date")


@query("count_rows", "A-02", "SELECT count(*) AS n FROM change_log", views="change_log")
def _(t):
    return aggregates.count_rows(t.change_log)


@query(
    "log_summary",
    "A-03",
    "SELECT count(lsn) AS log_records, CAST(sum(coalesce(n_locks, 0)) AS BIGINT) AS locks FROM change_log",
    views="change_log",
)
def _(t):
    return aggregates.log_summary(t.change_log)


@query("select_distinct", "A-04", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t):
    return aggregates.select_distinct(t.orders, "o_custkey", "o_orderstatus")


@query(
    "event_fire_stats",
    "A-05",
    """SELECT session_id, event_name, count(*) AS event_fire_count,
              CAST((2 * sum(duration_us) + count(*)) // (2 * count(*)) AS BIGINT) AS event_fire_average_time,
              min(duration_us) AS event_fire_min_time, max(duration_us) AS event_fire_max_time
       FROM xe_events GROUP BY session_id, event_name""",
    views="xe_events",
)
def _(t):
    return aggregates.event_fire_stats(t.xe_events)


@query(
    "average_time_baseline",
    "A-06",
    """SELECT x.event_id, x.event_name, x.duration_us, b.usual_runs, b.usual_time,
              CASE WHEN x.duration_us > b.usual_time THEN 1 WHEN b.usual_time IS NOT NULL THEN 0 END AS is_slower
       FROM xe_events x LEFT JOIN (
         SELECT event_name, count(*) AS usual_runs,
                CAST((2 * sum(duration_us) + count(*)) // (2 * count(*)) AS BIGINT) AS usual_time
         FROM xe_events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY event_name) b USING (event_name)
       WHERE x.ts >= TIMESTAMP '2024-01-20'""",
    views="xe_events",
)
def _(t):
    runs = t.xe_events.select("event_id", "event_name", "duration_us", "ts")
    split = F.lit(BASELINE_END).cast("timestamp_ntz")
    earlier, current = runs.where(F.col("ts") < split), runs.where(F.col("ts") >= split)
    return activity.average_time_baseline(earlier, current.drop("ts"), "event_name", "duration_us")


@query(
    "block_leaders",
    "A-07",
    """WITH chain AS (
         SELECT collection_time, session_id, blocking_session_id AS direct, blocking_session_id AS reached
         FROM activity WHERE blocking_session_id IS NOT NULL
         UNION ALL
         SELECT c.collection_time, c.session_id, c.direct, a.blocking_session_id
         FROM chain c JOIN activity a ON a.collection_time = c.collection_time AND a.session_id = c.reached
         WHERE a.blocking_session_id IS NOT NULL),
       heads AS (
         SELECT c.collection_time, c.reached AS session_id, count(*) AS blocked_session_count,
                count(*) FILTER (WHERE c.direct = c.reached) AS blocked_direct
         FROM chain c LEFT JOIN activity a ON a.collection_time = c.collection_time AND a.session_id = c.reached
         WHERE a.blocking_session_id IS NULL GROUP BY c.collection_time, c.reached)
       SELECT h.collection_time, h.session_id, h.blocked_session_count, h.blocked_direct,
              a.login_name, a.wait_info, a.open_tran_count
       FROM heads h LEFT JOIN activity a USING (collection_time, session_id)""",
    views="activity",
    recursive=True,
)
def _(t):
    return blocking.block_leaders(t.activity, ["login_name", "wait_info", "open_tran_count"])


@query(
    "transaction_log_usage",
    "A-08",
    """SELECT transaction_id, count(*) AS log_records,
              count(*) FILTER (WHERE operation = 'LOP_MODIFY_ROW') AS row_changes,
              CAST(sum(coalesce(n_locks, 0)) AS BIGINT) AS locks, min(lsn) AS first_lsn, max(lsn) AS last_lsn,
              CASE WHEN max(lsn) FILTER (WHERE operation = 'LOP_BEGIN_XACT')
                        > coalesce(max(lsn) FILTER (WHERE operation = 'LOP_COMMIT_XACT'), -1) THEN 1 ELSE 0 END AS is_open
       FROM change_log GROUP BY transaction_id""",
    views="change_log",
)
def _(t):
    return aggregates.transaction_log_usage(t.change_log)


@query(
    "tempdb_usage",
    "A-09",
    """SELECT session_id, collection_time, login_name, start_time, wait_info, tempdb_current FROM (
         SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY collection_time DESC) AS r FROM activity) s
       WHERE r = 1""",
    views="activity",
)
def _(t):
    return activity.tempdb_usage(t.activity)


@query(
    "memory_usage",
    "A-10",
    """SELECT session_id, collection_time, login_name, start_time, cpu_total FROM (
         SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY collection_time DESC) AS r FROM activity) s
       WHERE r = 1""",
    views="activity",
)
def _(t):
    return activity.memory_usage(t.activity, "cpu_total")


@query(
    "wait_profile",
    "A-11",
    """SELECT session_id, wait_info, count(*) AS times_seen, min(collection_time) AS first_seen,
              max(collection_time) AS last_seen
       FROM activity WHERE wait_info IS NOT NULL GROUP BY session_id, wait_info""",
    views="activity",
)
def _(t):
    return activity.wait_profile(t.activity)


@query(
    "lock_profile",
    "A-12",
    """SELECT transaction_id, n_locks, count(*) AS records FROM change_log
       WHERE n_locks IS NOT NULL GROUP BY transaction_id, n_locks""",
    views="change_log",
)
def _(t):
    return aggregates.lock_profile(t.change_log)


@query(
    "log_by_operation",
    "A-13",
    "SELECT operation, count(*) AS records FROM change_log GROUP BY operation",
    views="change_log",
)
def _(t):
    return aggregates.log_by_operation(t.change_log)


@query(
    "log_by_transaction_and_operation",
    "A-13",
    """SELECT transaction_id,
              count(*) FILTER (WHERE operation = 'LOP_BEGIN_XACT') AS LOP_BEGIN_XACT,
              count(*) FILTER (WHERE operation = 'LOP_MODIFY_ROW') AS LOP_MODIFY_ROW,
              count(*) FILTER (WHERE operation = 'LOP_COMMIT_XACT') AS LOP_COMMIT_XACT
       FROM change_log GROUP BY transaction_id""",
    views="change_log",
)
def _(t):
    return aggregates.log_by_transaction_and_operation(t.change_log)


@query(
    "activity_delta",
    "W-01",
    """SELECT *,
         cpu_total - lag(cpu_total) OVER (PARTITION BY session_id ORDER BY collection_time) AS cpu_total_delta,
         tempdb_current - lag(tempdb_current) OVER (PARTITION BY session_id ORDER BY collection_time)
           AS tempdb_current_delta
       FROM activity""",
    views="activity",
)
def _(t):
    return activity.activity_delta(t.activity, ["cpu_total", "tempdb_current"])


@query(
    "tempdb_delta_top",
    "W-02",
    """SELECT collection_time, session_id, tempdb_current, tempdb_current_delta FROM (
         SELECT *, tempdb_current - lag(tempdb_current) OVER (PARTITION BY session_id ORDER BY collection_time)
                     AS tempdb_current_delta FROM activity) d
       WHERE tempdb_current_delta IS NOT NULL
       ORDER BY tempdb_current_delta DESC, collection_time, session_id""",
    views="activity",
)
def _(t):
    return activity.tempdb_delta_top(t.activity)


@query(
    "parameter_sensitivity",
    "W-03",
    """SELECT * FROM (
         SELECT event_name, count(*) AS runs, min(duration_us) AS min_time, max(duration_us) AS max_time,
                CAST((2 * sum(duration_us) + count(*)) // (2 * count(*)) AS BIGINT) AS avg_time,
                CAST((max(duration_us) * 100 * count(*)) // sum(duration_us) AS BIGINT) AS slowest_percent
         FROM xe_events GROUP BY event_name) s
       WHERE slowest_percent >= 300""",
    views="xe_events",
)
def _(t):
    return activity.parameter_sensitivity(t.xe_events, "event_name", "duration_us", 300)


@query(
    "blocked_sessions",
    "W-04",
    """SELECT event_id, ts AS lock_start, session_id, database_id, event_name, duration_us, severity, result, spills,
              client_app_name, lock_end, epoch_us(lock_end) - epoch_us(ts) AS waited_us
       FROM (SELECT *, lead(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS lock_end FROM xe_events) w
       WHERE event_name = 'error' AND epoch_us(lock_end) - epoch_us(ts) >= 5000000""",
    views="xe_events",
)
def _(t):
    # Only what is reported goes through the exchange.
    kept = ["event_id", "ts", "session_id", "database_id", "event_name", "duration_us", "severity", "result", "spills", "client_app_name"]
    return activity.blocked_sessions(t.xe_events.select(*kept), F.col("event_name") == "error")


@query(
    "deadlock_cycles",
    "W-05",
    """WITH walk AS (
         SELECT waiter AS origin, holder AS reached FROM wait_edges WHERE holder IS NOT NULL
         UNION
         SELECT w.origin, e.holder FROM walk w JOIN wait_edges e ON e.waiter = w.reached WHERE e.holder IS NOT NULL),
       ring AS (SELECT w.origin, min(w.reached) AS deadlock_id, count(*) AS participants FROM walk w
                WHERE w.origin IN (SELECT origin FROM walk WHERE origin = reached) GROUP BY w.origin)
       SELECT r.deadlock_id, r.participants, e.waiter, e.holder
       FROM ring r JOIN wait_edges e ON e.waiter = r.origin""",
    views="wait_edges",
    recursive=True,
)
def _(t):
    return blocking.deadlock_cycles(t.wait_edges)


@query(
    "deadlocks_of_several_holders",
    "W-05",
    """WITH walk AS (
         SELECT waiter AS origin, holder AS reached FROM wait_edges_many WHERE holder IS NOT NULL
         UNION
         SELECT w.origin, e.holder FROM walk w JOIN wait_edges_many e ON e.waiter = w.reached WHERE e.holder IS NOT NULL),
       mutual AS (
         SELECT a.origin, min(a.reached) AS deadlock_id, count(*) AS participants
         FROM walk a JOIN walk b ON b.origin = a.reached AND b.reached = a.origin GROUP BY a.origin)
       SELECT DISTINCT m.deadlock_id, m.participants, e.waiter, e.holder
       FROM wait_edges_many e JOIN mutual m ON m.origin = e.waiter
       JOIN mutual h ON h.origin = e.holder AND h.deadlock_id = m.deadlock_id""",
    views="wait_edges_many",
    recursive=True,
)
def _(t):
    return blocking.deadlock_cycles(t.wait_edges_many)
