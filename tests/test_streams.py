"""Streams return what the same capture returns on the batch."""

import pytest
from pyspark.sql import functions as F

from sparktide.operators import history
from sparktide.plans.views import Tables
from sparktide.sources import event_xml
from sparktide.streaming import captures, sinks

RULES = {
    "long_running": captures.long_running_rule,
    "failed_queries": captures.failed_queries_rule,
    "aborted_queries": lambda: captures.aborted_queries_rule(["error"]),
    "antipattern_events": lambda: captures.antipattern_events_rule(["app_1"]),
    "spills": captures.spills_rule,
    "tempdb_growth": lambda: captures.tempdb_growth_rule(None),
    "blocked_process": lambda: captures.blocked_process_rule(["purchase"]),
    "deadlocks": lambda: captures.deadlocks_rule(["error"]),
}


def test_missing_columns_are_an_error(tables):
    with pytest.raises(ValueError, match="sql_text"):
        captures.long_running(tables.xe_events.drop("sql_text"))
    with pytest.raises(ValueError, match="sql_text"):
        captures.fan_out(tables.xe_events.drop("sql_text"), {"long_running": captures.long_running_rule()})


@pytest.fixture(scope="module")
def parts(spark, tables):
    """The events in several files, to be read in several micro-batches."""
    from sparktide.workspace import new_path

    path = new_path(spark, "parts")
    tables.events.orderBy("ts").repartitionByRange(6, "ts").write.parquet(f"{path}/events.parquet")
    return path


def _stream(spark, path, schema, files=None):
    return Tables.as_xe_events(sinks.event_stream(spark, path, "events", schema, files))


def test_one_stream_serves_all_targets(spark, tables, parts, assert_same):
    """One pass in several micro-batches gives each target what its capture finds in the batch."""
    rules = {name: rule() for name, rule in RULES.items()}
    stream = captures.fan_out(_stream(spark, parts, tables.events.schema, files=2), rules)
    written = sinks.captured(stream, "fan_out", "capture")
    for name, rule in rules.items():
        target = written.where(F.col("capture") == name)
        assert_same(captures.capture(tables.xe_events, rule), target.select(*captures.BASE, *rule.columns))
        others = [c for c in written.columns if c not in ("capture", *captures.BASE, *rule.columns)]
        assert target.where(" OR ".join(f"{c} IS NOT NULL" for c in others)).isEmpty()


def test_stream_equals_batch(spark, tables, parts, assert_same):
    stream = _stream(spark, parts, tables.events.schema, files=2)
    assert_same(captures.spills(tables.xe_events), sinks.captured(captures.spills(stream), "capture"))


@pytest.mark.parametrize("key", ["event_name", None])
def test_ring_buffer_over_many_batches(spark, tables, parts, assert_same, work, key):
    stream = _stream(spark, parts, tables.events.schema, files=1)
    held = 5, ["ts", "event_id"], key
    sinks.ring_buffer(stream, *held, work).awaitTermination()
    got = sinks.read_ring_buffer(spark, work, stream.schema, *held)
    assert_same(got, sinks.recent_events(tables.xe_events, 5, [F.desc("ts"), F.desc("event_id")], key))


def test_ring_buffer_keeps_repeated_events_and_every_value(spark, assert_same, work):
    """Equal events stay several, null keys are a key, and a second run goes on from what is held."""
    rows = spark.range(60).select(
        F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("k"),
        F.timestamp_seconds(F.lit(1.7e9) + F.floor(F.col("id") / 6) + F.lit(0.123456)).alias("ts"),
        F.expr("timestamp_ntz'2024-03-31 02:30:00.000001'").alias("local"),
        F.when(F.col("id") > 30, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("day"),
        F.expr("CASE WHEN id < 40 THEN CAST('NaN' AS DOUBLE) ELSE id / 7 END").alias("share"),
        F.expr("CAST(id AS DECIMAL(20, 4)) / 3").alias("cost"),
        F.expr("array(encode(string(id div 6), 'UTF-8'), null)").alias("raw"),
    ).drop("id")
    rows = rows.unionByName(rows)
    held = 7, ["ts", "day"], "k"
    for run in range(2):
        part = F.col("ts") < F.timestamp_seconds(F.lit(1_700_000_005))
        rows.where(part if run else ~part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/in")
        sinks.ring_buffer(stream, *held, f"{work}/c", spread=3).awaitTermination()
    got = sinks.read_ring_buffer(spark, f"{work}/c", rows.schema, *held)
    want = sinks.recent_events(spark.read.parquet(f"{work}/in"), 7, [F.desc("ts"), F.desc("day")], "k")
    assert got.count() == 21
    assert_same(got.select("k", "ts", "local", "day"), want.select("k", "ts", "local", "day"))
    whole = spark.read.parquet(f"{work}/in")
    assert got.exceptAll(whole).isEmpty()


def test_ring_buffer_needs_an_order_in_time(spark, tables, parts, work):
    with pytest.raises(ValueError, match="event_name"):
        sinks.ring_buffer(_stream(spark, parts, tables.events.schema), 5, ["event_name"], None, work)


def test_latest_of_a_hot_key_are_cut_in_parts(tables, monkeypatch, assert_same):
    order = [F.desc("ts"), F.desc("event_id")]
    plain = sinks.recent_events(tables.xe_events, 40, order, "event_name")
    monkeypatch.setattr(sinks, "GROUP_LIMIT", 10)
    monkeypatch.setattr(sinks, "FEWER", 4)
    assert_same(plain, sinks.recent_events(tables.xe_events, 40, order, "event_name", spread=16))


def test_sink_resumes_without_repeating(spark, tables, parts, work):
    def run():
        stream = _stream(spark, parts, tables.events.schema)
        sinks.event_file_sink(stream, f"{work}/o", f"{work}/c").awaitTermination()
        return spark.read.parquet(f"{work}/o").count()

    assert run() == tables.events.count()
    assert run() == tables.events.count()


def test_restart_replaces_the_running_capture(spark, tables, parts, work):
    def start(label):
        stream = _stream(spark, parts, tables.events.schema)
        return (
            stream.writeStream.format("parquet").queryName("long_running")
            .option("checkpointLocation", f"{work}/c{label}").start(f"{work}/o{label}")
        )

    first = sinks.restart_capture(spark, "long_running", lambda: start(1))
    second = sinks.restart_capture(spark, "long_running", lambda: start(2))
    assert not first.isActive and second.isActive
    second.stop()


def test_rate_counts_every_window(spark, tables, parts, assert_same):
    """What a bounded run emitted and what it still held are all windows, none twice."""
    stream = _stream(spark, parts, tables.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    emitted = sinks.captured(captures.event_rate(stream, "6 hours", "10 minutes"), "rate")
    batch = tables.xe_events.withColumn("ts", F.col("ts").cast("timestamp"))
    held = captures.open_windows(batch, "6 hours", "10 minutes")
    assert held.count() > 0
    expected = batch.groupBy(F.window("ts", "6 hours"), "event_name").agg(F.count("*").alias("n_events"))
    expected = expected.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_name", "n_events")
    assert_same(expected, emitted.union(held))
    assert captures.open_windows(batch.limit(0), "6 hours", "10 minutes").count() == 0


def _buffer(*events, closed=True):
    return "<RingBufferTarget>" + "".join(events) + ("</RingBufferTarget>" if closed else "")


def _report(deadlock):
    return f'<event name="xml_deadlock_report" timestamp="t"><data name="other"><value>1</value></data><data name="xml_report"><value>{deadlock}</value></data></event>'


_PROCESSES = "".join(f'<process id="p{i}" spid="{i}"/>' for i in range(1, 5))
_GRAPH = (
    f'<deadlock><victim-list><victimProcess id="p2"/></victim-list><process-list>{_PROCESSES}</process-list><resource-list>'
    '<keylock objectname="a"><owner-list><owner id="p1" mode="X"/></owner-list>'
    '<waiter-list><waiter id="p2" mode="U"/><waiter id="p3" mode="S"/></waiter-list></keylock>'
    '<keylock objectname="b"><owner-list><owner id="p2" mode="X"/></owner-list><waiter-list><waiter id="p1" mode="U"/></waiter-list></keylock>'
    '<ridlock objectname="c"><owner-list><owner id="p3" mode="X"/><owner id="p9" mode="X"/></owner-list><waiter-list><waiter id="p4" mode="X"/></waiter-list></ridlock>'
    "</resource-list></deadlock>"
)


def _reports(spark, buffers):
    rows = spark.createDataFrame(
        [(i, *b) for i, b in enumerate(buffers)], "session_address int, session_name string, target_name string, target_data string"
    )
    return event_xml.deadlock_reports(rows.select("session_address", "session_name"), rows.drop("session_name"))


def test_reports_of_broken_and_foreign_documents_are_skipped(spark):
    health = "system_health", "ring_buffer"
    buffers = [
        (*health, _buffer('<event name="wait_info"/>', _report("<deadlock><a>x</a></deadlock>"), _report("none"))),
        (*health, "<RingBufferTarget><event"),
        ("system_health", "event_file", _buffer(_report(_GRAPH))),
        ("other", "ring_buffer", _buffer(_report(_GRAPH))),
        (*health, None), (*health, ""), (*health, _buffer(_report(_GRAPH), closed=False)), (*health, _buffer()),
    ]
    found = _reports(spark, buffers).collect()
    assert [tuple(r) for r in found] == [(0, 1, "t", "<deadlock><a>x</a></deadlock>"), (0, 2, "t", None)]


def test_waits_of_a_deadlock_graph(spark):
    """Several waiters and owners, kinds of locks mixed, an owner that isn't listed."""
    reports = _reports(spark, [("system_health", "ring_buffer", _buffer(_report(_GRAPH), _report("<deadlock>?</deadlock>")))])
    got = event_xml.deadlock_waits(reports).drop("session_address", "place").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            (2, 1, "keylock", "a", "U", True), (3, 1, "keylock", "a", "S", False), (1, 2, "keylock", "b", "U", False),
            (4, 3, "ridlock", "c", "X", False), (4, None, "ridlock", "c", "X", False),
        ],
        key=str,
    )


def test_any_well_formed_plan_survives(spark):
    plans = [
        ('<plan><op><name>Scan</name></op></plan>', "Scan"), ('<plan a="1"><op><name>x</name></op><op><name>y</name></op></plan>', "x"),
        ("<plan/>", None), ("<plan><op", None), ("<plan><op></plan>", None), ("no xml", None), ("", None), (None, None),
        ('<other><deep><deeper k="v">1</deeper></deep></other>', None),
    ]
    df = spark.createDataFrame(list(enumerate(p for p, _ in plans)), "id int, text string")
    parsed = df.withColumn("plan", history.parsed_plan(F.col("text")))
    name = F.coalesce(history.plan_value("plan", "$.op.name", "string"), history.plan_value("plan", "$.op[0].name", "string"))
    got = parsed.select("id", name.alias("name"), history.plan_value("plan", "$.deep.deeper._k", "string").alias("k")).orderBy("id").collect()
    assert [r.name for r in got] == [n for _, n in plans]
    assert got[-1].k == "v"
