"""Event buffers that arrive as one XML document per session target, and the deadlocks in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An event with its data; the value of a report is kept as the text of its fragment.
EVENT_ROW = (
    "event ARRAY<STRUCT<_name: STRING, _timestamp: STRING,"
    " data: ARRAY<STRUCT<_name: STRING, value: STRUCT<deadlock: STRING>>>>>"
)

# Kinds of resources in a deadlock; fixed names.
RESOURCES = ("keylock", "pagelock", "ridlock", "objectlock", "databaselock", "metadatalock", "hobtlock", "applicationlock", "exchangeEvent")

_ENDS = "STRUCT<{0}: ARRAY<STRUCT<_id: STRING, _mode: STRING>>>"
_LOCK = f"STRUCT<_objectname: STRING, _mode: STRING, `owner-list`: {_ENDS.format('owner')}, `waiter-list`: {_ENDS.format('waiter')}>"
DEADLOCK_ROW = (
    "`victim-list` STRUCT<victimProcess: ARRAY<STRUCT<_id: STRING>>>,"
    " `process-list` STRUCT<process: ARRAY<STRUCT<_id: STRING, _spid: BIGINT, _waitresource: STRING, inputbuf: STRING>>>,"
    f" `resource-list` STRUCT<{', '.join(f'{kind}: ARRAY<{_LOCK}>' for kind in RESOURCES)}>"
)


def read_event_xml(df: DataFrame, col: str, row_tag: str, schema: str = EVENT_ROW) -> DataFrame:
    """The document parsed beside its row; broken documents give null fields."""
    return df.withColumn("document", F.from_xml(F.col(col), schema, {"rowTag": row_tag}))


def session_buffers(sessions: DataFrame, targets: DataFrame, session: str, target: str) -> DataFrame:
    """Buffers of one named session and target kind."""
    wanted = sessions.where(F.col("session_name") == session).select("session_address")
    return targets.where(F.col("target_name") == target).join(wanted, "session_address", "inner")


def xml_nodes(parsed: DataFrame, nodes: str, name: str) -> DataFrame:
    """One row per node of the given name, with its place in the document from 0."""
    every = parsed.select("session_address", F.posexplode(f"document.{nodes}").alias("place", "node"))
    return every.where(F.col("node._name") == name)


def deadlock_reports(sessions: DataFrame, targets: DataFrame) -> DataFrame:
    """Deadlock reports in the default session's memory buffer: (session_address, place, reported_at, deadlock).

    ``deadlock`` is the first deadlock fragment of an event, as XML text; an event without
    one has a null.
    """
    buffers = session_buffers(sessions, targets, "system_health", "ring_buffer")
    parsed = read_event_xml(buffers, "target_data", "RingBufferTarget")
    found = xml_nodes(parsed, "event", "xml_deadlock_report")
    fragments = F.filter("node.data.value.deadlock", lambda d: d.isNotNull())
    inner = F.get(fragments, F.lit(0))
    return found.select(
        "session_address", "place", F.col("node._timestamp").alias("reported_at"),
        F.when(inner.isNotNull(), F.concat(F.lit("<deadlock>"), inner, F.lit("</deadlock>"))).alias("deadlock"),
    )


def _all_locks(graph: Column) -> Column:
    """Every lock of a deadlock with its kind, its owners and its waiters."""

    def of_kind(kind: str) -> Column:
        locks = F.coalesce(graph["resource-list"][kind], F.from_json(F.lit("[]"), f"ARRAY<{_LOCK}>"))
        return F.transform(
            locks,
            lambda k: F.struct(
                F.lit(kind).alias("kind"), k["_objectname"].alias("object_name"),
                k["owner-list"]["owner"].alias("owners"), k["waiter-list"]["waiter"].alias("waiters"),
            ),
        )

    return F.concat(*[of_kind(kind) for kind in RESOURCES])


def deadlock_waits(reports: DataFrame) -> DataFrame:
    """Who waited for whom in each report of ``deadlock_reports``.

    session_address, place, waiter and holder (sessions), resource, object_name,
    wait_mode, is_victim. A waiter has a row per owner of the lock it wants; fragments that
    can't be read have none.
    """
    graph = F.from_xml("deadlock", DEADLOCK_ROW, {"rowTag": "deadlock"})
    parsed = reports.where(F.col("deadlock").isNotNull()).withColumn("graph", graph)
    processes = F.col("graph")["process-list"]["process"]
    spids = F.map_from_entries(F.transform(processes, lambda p: F.struct(p["_id"], p["_spid"])))
    listed = parsed.select(
        "session_address", "place", F.when(processes.isNotNull(), spids).alias("spids"),
        F.col("graph")["victim-list"]["victimProcess"]["_id"].alias("victims"), F.explode(_all_locks(F.col("graph"))).alias("lock"),
    )
    waiters = listed.withColumn("waiter", F.explode("lock.waiters"))
    pairs = waiters.withColumn("owner", F.explode("lock.owners"))
    return pairs.select(
        "session_address", "place",
        F.element_at("spids", F.col("waiter._id")).alias("waiter"),
        F.element_at("spids", F.col("owner._id")).alias("holder"),
        F.col("lock.kind").alias("resource"), F.col("lock.object_name").alias("object_name"),
        F.col("waiter._mode").alias("wait_mode"),
        F.coalesce(F.array_contains("victims", F.col("waiter._id")), F.lit(False)).alias("is_victim"),
    )
