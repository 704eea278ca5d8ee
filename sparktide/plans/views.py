"""Derived views that bind the operators to the local tables.

Every view exists twice: built with DataFrames here, and as SQL text in
``VIEW_SQL`` for the engine that checks the results.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktide.operators import slices
from sparktide.sources import tables as source_tables

# Sessions whose neighbours are looked for together.
SESSION_BLOCK = 64

SETTING_NAMES = ("clr enabled", "clr strict security", "xp_cmdshell", "max degree of parallelism")


# A plan document, for both engines: statements with one to three operators inside each other,
# some documents cut short.
_PLAN_TEXT = (
    "CASE WHEN o_orderkey % 10 = 0 THEN '<ShowPlanXML Version=\"1.5\"><BatchSequence><Batch'"
    " ELSE concat('<ShowPlanXML Version=\"1.5\"><BatchSequence><Batch><Statements><StmtSimple StatementId=\"',"
    " CAST(o_orderkey % 7 AS STRING), '\" StatementText=\"SELECT 1 WHERE 1 &lt; 2\"><QueryPlan DegreeOfParallelism=\"',"
    " CAST(o_custkey % 8 AS STRING), '\">',"
    " CASE WHEN o_orderkey % 3 > 0 THEN concat('<RelOp NodeId=\"0\" PhysicalOp=\"Sort\" EstimateRows=\"', CAST(o_custkey AS STRING), '\">') ELSE '' END,"
    " CASE WHEN o_orderkey % 3 > 1 THEN '<RelOp NodeId=\"1\" PhysicalOp=\"Filter\" EstimateRows=\"5\">' ELSE '' END,"
    " concat('<RelOp NodeId=\"2\" PhysicalOp=\"Scan\" EstimateRows=\"', CAST(o_custkey AS STRING), '\"/>'),"
    " CASE WHEN o_orderkey % 3 > 1 THEN '</RelOp>' ELSE '' END, CASE WHEN o_orderkey % 3 > 0 THEN '</RelOp>' ELSE '' END,"
    " '</QueryPlan></StmtSimple></Statements></Batch></BatchSequence></ShowPlanXML>') END AS query_plan"
)

# A buffer of events with a deadlock report, for both engines: a session that waits for one or
# two owners of a lock, one of which waits back; some buffers are cut short.
DEADLOCK_XML = (
    "concat('<deadlock><victim-list><victimProcess id=\"p1\"/></victim-list><process-list>',"
    " '<process id=\"p1\" spid=\"', CAST(user_id AS STRING), '\" waitresource=\"KEY: 5\"><inputbuf>UPDATE a</inputbuf></process>',"
    " '<process id=\"p2\" spid=\"', CAST(user_id + 1000 AS STRING), '\"/><process id=\"p3\" spid=\"', CAST(user_id + 2000 AS STRING), '\"/>',"
    " '</process-list><resource-list><keylock objectname=\"Dead\" mode=\"X\"><owner-list><owner id=\"p2\" mode=\"X\"/>',"
    " CASE WHEN event_id % 4 = 0 THEN '<owner id=\"p3\" mode=\"S\"/>' ELSE '' END,"
    " '</owner-list><waiter-list><waiter id=\"p1\" mode=\"U\"/></waiter-list></keylock>',"
    " '<pagelock objectname=\"Lock\" mode=\"X\"><owner-list><owner id=\"p1\" mode=\"X\"/></owner-list>',"
    " '<waiter-list><waiter id=\"p2\" mode=\"S\"/></waiter-list></pagelock></resource-list></deadlock>')"
)
_BUFFER = (
    "concat('<RingBufferTarget truncated=\"0\"><event name=\"', CASE event_type WHEN 'error' THEN 'xml_deadlock_report' ELSE event_type END,"
    " '\" timestamp=\"2024-01-01T00:00:00Z\"><data name=\"xml_report\"><value>',"
    f" CASE event_type WHEN 'error' THEN {DEADLOCK_XML} ELSE 'none' END, '</value></data></event>',"
    " '<event name=\"wait_info\" timestamp=\"2024-01-01T00:00:01Z\"><data name=\"duration\"><value>0</value></data></event>',"
    " CASE WHEN event_id % 5 = 0 THEN '' ELSE '</RingBufferTarget>' END)"
)

# The holders of a session, for both engines: cycles that share sessions, rings with short cuts
# and chains between them, within each hundred sessions.
_HOLDERS = (
    "CASE WHEN c_custkey % 100 < 99 THEN c_custkey + 1 END",
    "CASE c_custkey % 100 WHEN 3 THEN c_custkey - 2 WHEN 6 THEN c_custkey - 2 WHEN 20 THEN c_custkey + 5 WHEN 30 THEN c_custkey - 12"
    " WHEN 41 THEN c_custkey WHEN 59 THEN c_custkey - 9 WHEN 57 THEN c_custkey - 2 WHEN 70 THEN c_custkey + 1 END",
)

# Roles and their members, for both engines: a login in a role, a login with all rights, a role
# in a role; roles 5 and 20 are inside each other.
_MEMBERSHIPS = (
    ("concat('role_', CAST(c_custkey % 37 AS STRING))", "CASE WHEN c_custkey % 20 = 0 THEN concat('##', c_name, '##') ELSE c_name END"),
    ("CASE WHEN c_nationkey = 0 THEN 'sysadmin' END", "c_name"),
    ("CASE WHEN c_custkey IN (5, 11) THEN 'sysadmin' WHEN c_custkey BETWEEN 1 AND 36"
     " THEN concat('role_', CAST(CASE c_custkey WHEN 20 THEN 5 WHEN 8 THEN 20 ELSE 36 END AS STRING)) END",
     "CASE WHEN c_custkey = 36 THEN 'role_12' ELSE concat('role_', CAST(c_custkey AS STRING)) END"),
    ("CASE WHEN c_custkey = 5 THEN 'role_20' END", "'role_5'"),
)

# What events carry besides their measures, as SQL for both engines.
_XE_ACTIONS = (
    "concat('app_', CAST(event_id % 6 AS STRING)) AS client_app_name",
    "concat('host_', CAST(user_id % 13 AS STRING)) AS client_hostname",
    "concat('login_', CAST(user_id % 7 AS STRING)) AS username",
    "CASE event_id % 5 WHEN 0 THEN 'master' WHEN 2 THEN 'tempdb' ELSE concat('db_', CAST(event_id % 5 AS STRING)) END AS database_name",
    "concat('0x06', substr(md5(concat('plan', CAST(event_id % 997 AS STRING))), 1, 16)) AS plan_handle",
    "concat('0x', substr(md5(concat('query', CAST(event_id % 211 AS STRING))), 1, 16)) AS query_hash",
    "concat('0x', substr(md5(concat('shape', CAST(event_id % 307 AS STRING))), 1, 16)) AS query_plan_hash",
    "CASE WHEN event_id % 17 > 0 THEN concat('UPDATE t', CAST(event_id % 11 AS STRING), ' SET v = ', CAST(event_id AS STRING)) END AS sql_text",
    "concat('<frames><frame level=\"1\" line=\"', CAST(event_id % 90 AS STRING), '\"/></frames>') AS tsql_stack",
    "CASE WHEN event_type = 'purchase' THEN concat('<blocked-process-report><blocked-process><process spid=\"',"
    " CAST(user_id AS STRING), '\"/></blocked-process></blocked-process-report>') END AS blocked_process",
    "CAST(event_id % 4 AS INT) AS index_id",
    "CASE event_id % 4 WHEN 0 THEN 'X' WHEN 1 THEN 'U' WHEN 2 THEN 'S' ELSE 'IX' END AS lock_mode",
    "event_id % 101 AS object_id",
    "CASE WHEN event_id % 3 = 0 THEN 'LOCK' ELSE 'TRANSACTION' END AS resource_owner_type",
    "event_id * 7 AS transaction_id",
)

# The texts of ``query_log``, step by step, for both engines: the column, its literal and the
# number of terms; names plain, bracketed and qualified, lists wrapped, without blanks and with
# comments inside; the predicate alone, behind another one, behind a long list of columns and
# after a comment that holds a predicate itself.
_QUERY_PARTS = (
    "event_id",
    "CASE event_id % 5 WHEN 0 THEN 'Up_Votes' WHEN 1 THEN 'Display_Name' ELSE 'Views' END AS col",
    "CASE WHEN event_id % 7 = 0 THEN '''1''' WHEN event_id % 11 < 3 THEN concat('N''it', repeat(chr(39), 2), 's''') ELSE '1' END AS val",
    "CAST(event_id % 130 AS INT) AS more",
)
_QUERY_SPELLINGS = (
    "event_id",
    "col",
    "val",
    "more",
    "CASE event_id % 6 WHEN 0 THEN lower(col) WHEN 1 THEN concat('[', col, ']') WHEN 2 THEN concat('u.', col)"
    " WHEN 3 THEN concat('[dbo].[u].[', col, ']') WHEN 4 THEN upper(col) ELSE concat('u . [', col, ']') END AS name",
    "CASE event_id % 4 WHEN 0 THEN ', ' WHEN 1 THEN ',' WHEN 2 THEN concat(',', chr(10), '    ')"
    " ELSE ' /* , 7 */, ' END AS gap",
    "CASE event_id % 3 WHEN 0 THEN ' OR ' WHEN 1 THEN concat(chr(10), 'or ') ELSE ' Or /* OR */ ' END AS either",
    "CASE event_id % 9 WHEN 0 THEN 'SELECT * FROM u WHERE id = 5 AND ' WHEN 1 THEN concat('SELECT ', repeat('c, ', 70), 'c FROM u WHERE ')"
    " WHEN 2 THEN concat('-- WHERE views IN (1, 2)', chr(10), 'SELECT c FROM u WHERE ')"
    " WHEN 3 THEN 'UPDATE u SET views = 1 WHERE c = 2 and ' ELSE 'SELECT * FROM u WHERE ' END AS front",
)
_QUERY_TEXTS = (
    "event_id AS query_id",
    "lower(col) AS col",
    "CASE WHEN val = '1' THEN 'number' WHEN val = '''1''' THEN 'text' ELSE 'national' END AS literal",
    "more + 1 AS n_terms",
    "CASE WHEN event_id % 2 = 0 THEN concat(front, name, ' IN (', repeat(concat(val, gap), more), val, ')')"
    " ELSE concat(front, '(', name, ' = ', val, repeat(concat(either, name, '=', val), more), ')') END AS query_sql_text",
)

# Query texts that one task makes and cuts.
TEXTS_PER_TASK = 4_000


class Tables:
    """The tables of one folder and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return source_tables.scan(self.spark, self.folder, name)

    @cached_property
    def orders_nullable(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey",
            "o_custkey",
            "o_orderdate",
            "o_totalprice",
            "CASE WHEN o_orderkey % 10 != 0 THEN o_orderdate END AS ship_date",
        )

    @cached_property
    def users_antipattern(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_custkey AS id",
            "c_name AS display_name",
            "CAST(c_custkey % 700 AS INT) AS up_votes",
            "CAST(c_custkey % 130 AS INT) AS views_num",
            "CAST(c_custkey % 130 AS STRING) AS views_txt",
            "CAST(round(c_acctbal * 100) AS BIGINT) AS reputation",
        )

    @cached_property
    def users(self) -> DataFrame:
        """The source the table above was copied from: its views are numbers of their own."""
        return self.customer.selectExpr("c_custkey AS user_id", "CAST(c_custkey % 97 AS INT) AS user_views")

    @cached_property
    def activity(self) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("bigint")
        first_type = F.min("event_type")
        hourly = self.events.groupBy(
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("collection_time"),
            F.col("user_id").alias("session_id"),
        ).agg(
            F.when(first_type == "error", "LCK_M_X")
            .when(first_type == "purchase", "WRITELOG")
            .when(first_type == "click", "PAGEIOLATCH_SH")
            .alias("wait_info"),
            F.min("ts").alias("start_time"),
            F.when(first_type.isin("error", "purchase"), 1).otherwise(0).alias("blocked"),
            F.sum(cents).alias("cpu"),
            F.max(cents).alias("tempdb_current"),
            F.count("*").alias("open_tran_count"),
        )
        chained = slices.neighbour(
            hourly,
            ["collection_time"],
            ["session_id"],
            {"previous_session": "session_id"},
            F.floor(F.col("session_id") / SESSION_BLOCK),
        )
        # A session has one row per hour, so its window is bounded by the hours covered.
        so_far = Window.partitionBy("session_id").orderBy("collection_time")
        counted = chained.withColumn("cpu_total", F.sum("cpu").over(so_far))
        return counted.select(
            "collection_time",
            "session_id",
            F.concat(F.lit("login_"), (F.col("session_id") % 7).cast("string")).alias("login_name"),
            F.when(F.col("session_id") % 4 == 0, "sleeping").otherwise("running").alias("status"),
            "wait_info",
            "start_time",
            F.when(F.col("blocked") == 1, F.col("previous_session")).alias("blocking_session_id"),
            "cpu_total",
            "tempdb_current",
            "open_tran_count",
        )

    @cached_property
    def qs_query(self) -> DataFrame:
        last = self.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
            F.max("l_shipdate").alias("last_execution_time")
        )
        return self.part.join(last, "p_partkey").selectExpr(
            "p_partkey AS query_id",
            "p_partkey - p_partkey % 10 AS query_text_id",
            "p_size AS object_id",
            "last_execution_time",
        )

    @cached_property
    def qs_text(self) -> DataFrame:
        return self.part.selectExpr(
            "p_partkey AS query_text_id",
            "concat('SELECT * FROM ', replace(p_name, ' ', '_'), ' WHERE size = ', CAST(p_size AS STRING))"
            " AS query_sql_text",
        )

    @cached_property
    def qs_plan(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey AS plan_id",
            "o_custkey AS query_id",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_forced_plan",
            "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS INT) ELSE 0 END AS force_failure_count",
            "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 > 0 THEN 8712 ELSE 0 END AS last_force_failure_reason",
            "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 > 0 THEN 'NO_INDEX' ELSE 'NONE' END"
            " AS last_force_failure_reason_desc",
            "o_orderdate AS last_execution_time",
            _PLAN_TEXT,
        )

    @cached_property
    def qs_stats(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey AS plan_id",
            "CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 3 ELSE 0 END AS execution_type",
            "CASE l_returnflag WHEN 'R' THEN 'Exception' WHEN 'A' THEN 'Aborted' ELSE 'Regular' END"
            " AS execution_type_desc",
            "CAST(l_quantity AS BIGINT) AS count_executions",
            "l_shipdate AS last_execution_time",
        )

    @cached_property
    def plan_cache(self) -> DataFrame:
        return self.qs_stats.groupBy("plan_id").agg(
            F.lit("Compiled Plan").alias("cacheobjtype"),
            F.when(F.col("plan_id") % 2 == 0, "Proc").otherwise("Adhoc").alias("objtype"),
            F.sum("count_executions").alias("usecounts"),
        )

    @cached_property
    def history_options(self) -> DataFrame:
        """One history store per database; a supplier stands for a database."""
        return self.supplier.selectExpr(
            "s_name AS database_name",
            "CASE WHEN s_suppkey % 4 = 0 THEN 'READ_ONLY' ELSE 'READ_WRITE' END AS actual_state_desc",
            "CASE WHEN s_suppkey % 4 = 0 THEN 65536 ELSE 0 END AS readonly_reason",
            "1000 + s_suppkey % 5 * 250 AS max_storage_size_mb",
            "s_suppkey * 37 % 1000 AS current_storage_size_mb",
            "900 AS flush_interval_seconds",
            "60 AS interval_length_minutes",
            "30 AS stale_query_threshold_days",
            "200 AS max_plans_per_query",
            "'AUTO' AS query_capture_mode_desc",
            "'AUTO' AS size_based_cleanup_mode_desc",
        )

    @cached_property
    def principals(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_custkey AS principal_id",
            "CASE WHEN c_custkey % 20 = 0 THEN concat('##', c_name, '##') ELSE c_name END AS name",
            "c_mktsegment AS type_desc",
            "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_disabled",
            "CASE WHEN c_nationkey = 0 THEN 1 ELSE 0 END AS is_sysadmin",
        )

    @cached_property
    def role_memberships(self) -> DataFrame:
        """Logins in one role each, and roles inside roles, some of them inside each other."""
        return self.customer.selectExpr("c_custkey", "c_name", "c_nationkey", "inline(array(" + ", ".join(
            f"named_struct('role_name', {role}, 'member_name', {member})" for role, member in _MEMBERSHIPS) + "))"
        ).where("role_name IS NOT NULL").select("role_name", "member_name")

    @cached_property
    def permissions(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_custkey AS grantee_principal_id",
            "CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'W' ELSE 'D' END AS state",
            "CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 1 END AS class",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'CL' ELSE 'CO' END AS type",
        )

    @cached_property
    def configurations(self) -> DataFrame:
        """The settings of many servers; a supplier stands for a server."""
        values = ["s_suppkey % 2", "s_suppkey % 3", "CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END", "8"]
        pairs = ", ".join(
            f"struct('{name}' AS name, CAST({value} AS INT) AS value)"
            for name, value in zip(SETTING_NAMES, values, strict=True)
        )
        return self.supplier.selectExpr("s_suppkey AS server_id", f"inline(array({pairs}))")

    @cached_property
    def credentials(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_name AS name",
            "sha2(CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN c_name WHEN 2 THEN 'password'"
            " ELSE concat(c_name, '!') END, 256) AS password_digest",
        )

    @cached_property
    def backupset(self) -> DataFrame:
        started = slices.neighbour(
            self.events, ["user_id"], ["ts", "event_id"], {"backup_start_date": "ts"}, F.to_date("ts")
        )
        return started.selectExpr(
            "event_id AS media_set_id",
            "concat('server_', CAST(user_id % 10 AS STRING)) AS server_name",
            "concat('db_', CAST(user_id AS STRING)) AS database_name",
            "CASE WHEN user_id % 3 = 0 THEN 'SIMPLE' ELSE 'FULL' END AS recovery_model",
            "CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END AS is_copy_only",
            "CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS is_snapshot",
            "CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS has_backup_checksums",
            "concat('login_', CAST(user_id % 7 AS STRING)) AS user_name",
            "CASE event_type WHEN 'click' THEN 'D' WHEN 'view' THEN 'D' WHEN 'error' THEN 'L' ELSE 'I' END AS type",
            "backup_start_date",
            "ts AS backup_finish_date",
            "CAST(round(value * 1000000) AS BIGINT) AS backup_size",
        )

    @cached_property
    def backupmediafamily(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id AS media_set_id",
            "concat('/backup/', CAST(event_id AS STRING)) AS physical_device_name",
            "CASE WHEN event_id % 4 = 0 THEN concat('device_', CAST(user_id AS STRING)) END AS logical_device_name",
            "CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 7 WHEN 3 THEN 9 ELSE 99 END AS device_type",
        )

    @staticmethod
    def as_xe_events(events: DataFrame) -> DataFrame:
        """Server events, from the batch table or from a stream over it."""
        return events.selectExpr(
            "event_id",
            "ts",
            "user_id AS session_id",
            "CAST(event_id % 5 AS INT) AS database_id",
            "event_type AS event_name",
            "CAST(round(value * 10000) AS BIGINT) AS duration_us",
            "CAST(event_id % 25 AS INT) AS severity",
            "CASE WHEN event_id % 10 = 0 THEN 'Abort' ELSE 'OK' END AS result",
            "CASE WHEN event_id % 8 = 0 THEN CAST(event_id % 3 AS INT) ELSE 0 END AS spills",
            *_XE_ACTIONS,
        )

    @cached_property
    def xe_events(self) -> DataFrame:
        return self.as_xe_events(self.events)

    @cached_property
    def xe_sessions(self) -> DataFrame:
        return self.events.select(F.col("user_id").alias("session_id")).distinct().select(
            "session_id", F.concat(F.lit("session_"), F.col("session_id").cast("string")).alias("session_name")
        )

    @cached_property
    def change_log(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id AS lsn",
            "user_id AS transaction_id",
            "CASE event_type WHEN 'signup' THEN 'LOP_BEGIN_XACT' WHEN 'view' THEN 'LOP_COMMIT_XACT'"
            " ELSE 'LOP_MODIFY_ROW' END AS operation",
            "CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE event_id % 4 END AS n_locks",
        )

    @cached_property
    def query_log(self) -> DataFrame:
        """Lists and OR chains of 1 to 130 terms in many spellings, on two text columns and on an integer one.

        A text is hundreds of times larger than its row in the file, so the ids are dealt out first.
        """
        ids = self.events.select("event_id")
        return ids.repartition(max(1, -(-ids.count() // TEXTS_PER_TASK))).selectExpr(*_QUERY_PARTS).selectExpr(*_QUERY_SPELLINGS).selectExpr(*_QUERY_TEXTS)

    @cached_property
    def column_types(self) -> DataFrame:
        return self.spark.createDataFrame(
            [("views", "nvarchar"), ("up_votes", "int"), ("display_name", "varchar")], "column_name string, type_name string"
        )

    @cached_property
    def event_xml(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id AS session_address",
            "CASE WHEN event_id % 3 = 0 THEN 'system_health' ELSE 'other' END AS session_name",
            "CASE WHEN event_id % 2 = 0 THEN 'ring_buffer' ELSE 'event_file' END AS target_name",
            f"{_BUFFER} AS target_data",
        )

    @cached_property
    def wait_edges(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_custkey AS waiter",
            "CASE c_custkey % 10 WHEN 1 THEN c_custkey - 1 WHEN 4 THEN c_custkey - 2 WHEN 9 THEN NULL"
            " ELSE c_custkey + 1 END AS holder",
        )

    @cached_property
    def wait_edges_many(self) -> DataFrame:
        """Waits of sessions with up to two holders, some of them twice."""
        return self.customer.selectExpr("c_custkey AS waiter", f"explode(array({', '.join(_HOLDERS)})) AS holder")


VIEW_SQL = {
    "orders_nullable": """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS ship_date
FROM orders""",
    "users_antipattern": """
SELECT c_custkey AS id, c_name AS display_name, CAST(c_custkey % 700 AS INT) AS up_votes,
       CAST(c_custkey % 130 AS INT) AS views_num, CAST(c_custkey % 130 AS STRING) AS views_txt,
       CAST(round(c_acctbal * 100) AS BIGINT) AS reputation
FROM customer""",
    "users": """
SELECT c_custkey AS user_id, CAST(c_custkey % 97 AS INT) AS user_views FROM customer""",
    "activity": """
SELECT collection_time, session_id, login_name, status, wait_info, start_time,
       CASE WHEN blocked = 1
            THEN lag(session_id) OVER (PARTITION BY collection_time ORDER BY session_id) END AS blocking_session_id,
       CAST(sum(cpu) OVER (PARTITION BY session_id ORDER BY collection_time) AS BIGINT) AS cpu_total,
       tempdb_current, open_tran_count
FROM (
  SELECT date_trunc('hour', ts) AS collection_time, user_id AS session_id,
         concat('login_', CAST(user_id % 7 AS STRING)) AS login_name,
         CASE WHEN user_id % 4 = 0 THEN 'sleeping' ELSE 'running' END AS status,
         CASE min(event_type) WHEN 'error' THEN 'LCK_M_X' WHEN 'purchase' THEN 'WRITELOG'
                              WHEN 'click' THEN 'PAGEIOLATCH_SH' END AS wait_info,
         min(ts) AS start_time,
         CASE WHEN min(event_type) IN ('error', 'purchase') THEN 1 ELSE 0 END AS blocked,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cpu,
         max(CAST(round(value * 100) AS BIGINT)) AS tempdb_current,
         count(*) AS open_tran_count
  FROM events GROUP BY date_trunc('hour', ts), user_id) s""",
    "qs_query": """
SELECT p_partkey AS query_id, p_partkey - p_partkey % 10 AS query_text_id, p_size AS object_id, m.last_execution_time
FROM part JOIN (SELECT l_partkey, max(l_shipdate) AS last_execution_time FROM lineitem GROUP BY l_partkey) m
  ON m.l_partkey = p_partkey""",
    "qs_text": """
SELECT p_partkey AS query_text_id,
       concat('SELECT * FROM ', replace(p_name, ' ', '_'), ' WHERE size = ', CAST(p_size AS STRING)) AS query_sql_text
FROM part""",
    "qs_plan": f"""
SELECT o_orderkey AS plan_id, o_custkey AS query_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_forced_plan,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS INT) ELSE 0 END AS force_failure_count,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 > 0 THEN 8712 ELSE 0 END AS last_force_failure_reason,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 > 0 THEN 'NO_INDEX' ELSE 'NONE' END
         AS last_force_failure_reason_desc,
       o_orderdate AS last_execution_time,
       {_PLAN_TEXT}
FROM orders""",
    "qs_stats": """
SELECT l_orderkey AS plan_id,
       CASE l_returnflag WHEN 'R' THEN 4 WHEN 'A' THEN 3 ELSE 0 END AS execution_type,
       CASE l_returnflag WHEN 'R' THEN 'Exception' WHEN 'A' THEN 'Aborted' ELSE 'Regular' END AS execution_type_desc,
       CAST(l_quantity AS BIGINT) AS count_executions, l_shipdate AS last_execution_time
FROM lineitem""",
    "plan_cache": """
SELECT l_orderkey AS plan_id, 'Compiled Plan' AS cacheobjtype,
       CASE WHEN l_orderkey % 2 = 0 THEN 'Proc' ELSE 'Adhoc' END AS objtype,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS usecounts
FROM lineitem GROUP BY l_orderkey""",
    "history_options": """
SELECT s_name AS database_name,
       CASE WHEN s_suppkey % 4 = 0 THEN 'READ_ONLY' ELSE 'READ_WRITE' END AS actual_state_desc,
       CASE WHEN s_suppkey % 4 = 0 THEN 65536 ELSE 0 END AS readonly_reason,
       1000 + s_suppkey % 5 * 250 AS max_storage_size_mb, s_suppkey * 37 % 1000 AS current_storage_size_mb,
       900 AS flush_interval_seconds, 60 AS interval_length_minutes, 30 AS stale_query_threshold_days,
       200 AS max_plans_per_query, 'AUTO' AS query_capture_mode_desc, 'AUTO' AS size_based_cleanup_mode_desc
FROM supplier""",
    "principals": """
SELECT c_custkey AS principal_id,
       CASE WHEN c_custkey % 20 = 0 THEN concat('##', c_name, '##') ELSE c_name END AS name,
       c_mktsegment AS type_desc, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_disabled,
       CASE WHEN c_nationkey = 0 THEN 1 ELSE 0 END AS is_sysadmin
FROM customer""",
    "role_memberships": "SELECT role_name, member_name FROM ("
    + " UNION ALL ".join(f"SELECT {role} AS role_name, {member} AS member_name FROM customer" for role, member in _MEMBERSHIPS)
    + ") m WHERE role_name IS NOT NULL",
    "permissions": """
SELECT o_custkey AS grantee_principal_id,
       CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'W' ELSE 'D' END AS state,
       CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 1 END AS class,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'CL' ELSE 'CO' END AS type
FROM orders""",
    "configurations": """
SELECT s_suppkey AS server_id, v.name,
       CAST(CASE v.name WHEN 'clr enabled' THEN s_suppkey % 2 WHEN 'clr strict security' THEN s_suppkey % 3
                        WHEN 'xp_cmdshell' THEN CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END ELSE 8 END AS INT) AS value
FROM supplier CROSS JOIN (VALUES ('clr enabled'), ('clr strict security'), ('xp_cmdshell'),
                                 ('max degree of parallelism')) AS v(name)""",
    "credentials": """
SELECT c_name AS name, sha256(CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN c_name WHEN 2 THEN 'password'
                                   ELSE concat(c_name, '!') END) AS password_digest
FROM customer""",
    "backupset": """
SELECT event_id AS media_set_id, concat('server_', CAST(user_id % 10 AS STRING)) AS server_name,
       concat('db_', CAST(user_id AS STRING)) AS database_name,
       CASE WHEN user_id % 3 = 0 THEN 'SIMPLE' ELSE 'FULL' END AS recovery_model,
       CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END AS is_copy_only,
       CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS is_snapshot,
       CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS has_backup_checksums,
       concat('login_', CAST(user_id % 7 AS STRING)) AS user_name,
       CASE event_type WHEN 'click' THEN 'D' WHEN 'view' THEN 'D' WHEN 'error' THEN 'L' ELSE 'I' END AS type,
       lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS backup_start_date,
       ts AS backup_finish_date, CAST(round(value * 1000000) AS BIGINT) AS backup_size
FROM events""",
    "backupmediafamily": """
SELECT event_id AS media_set_id, concat('/backup/', CAST(event_id AS STRING)) AS physical_device_name,
       CASE WHEN event_id % 4 = 0 THEN concat('device_', CAST(user_id AS STRING)) END AS logical_device_name,
       CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 7 WHEN 3 THEN 9 ELSE 99 END AS device_type
FROM events""",
    "xe_events": f"""
SELECT event_id, ts, user_id AS session_id, CAST(event_id % 5 AS INT) AS database_id, event_type AS event_name,
       CAST(round(value * 10000) AS BIGINT) AS duration_us, CAST(event_id % 25 AS INT) AS severity,
       CASE WHEN event_id % 10 = 0 THEN 'Abort' ELSE 'OK' END AS result,
       CASE WHEN event_id % 8 = 0 THEN CAST(event_id % 3 AS INT) ELSE 0 END AS spills,
       {", ".join(_XE_ACTIONS)}
FROM events""",
    "change_log": """
SELECT event_id AS lsn, user_id AS transaction_id,
       CASE event_type WHEN 'signup' THEN 'LOP_BEGIN_XACT' WHEN 'view' THEN 'LOP_COMMIT_XACT'
                       ELSE 'LOP_MODIFY_ROW' END AS operation,
       CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE CAST(event_id % 4 AS BIGINT) END AS n_locks
FROM events""",
    "query_log": f"""
SELECT {", ".join(_QUERY_TEXTS)}
FROM (SELECT {", ".join(_QUERY_SPELLINGS)} FROM (SELECT {", ".join(_QUERY_PARTS)} FROM events) p) q""",
    "wait_edges_many": f"SELECT c_custkey AS waiter, unnest([{', '.join(_HOLDERS)}]) AS holder FROM customer",
    "wait_edges": """
SELECT c_custkey AS waiter,
       CASE c_custkey % 10 WHEN 1 THEN c_custkey - 1 WHEN 4 THEN c_custkey - 2 WHEN 9 THEN NULL
                           ELSE c_custkey + 1 END AS holder
FROM customer""",
}


def with_views(names: tuple[str, ...], sql: str, recursive: bool = False) -> str:
    """``sql`` with the named views put in front as common table expressions."""
    if not names:
        return sql
    views = ", ".join(f"{name} AS ({VIEW_SQL[name].strip()})" for name in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = "," + body[4:]
    return f"WITH {'RECURSIVE ' if recursive else ''}{views} {body}"
