"""Queries of the source, sink and table-creation family; writes are read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparktide.plans.registry import query
from sparktide.sources import snapshots, tables
from sparktide.streaming import sinks
from sparktide.workspace import new_path

LOADED = dt.datetime(2024, 1, 1)


def _read(t, path, like):
    return t.spark.read.schema(like.schema).parquet(path)


@query(
    "generated_rows_against_orders",
    "S-01",
    """SELECT o_orderkey AS id, TIMESTAMP '2024-01-01' AS update_date, o_orderstatus FROM orders""",
)
def _(t):
    """A generated id for every order key between the least and the greatest, with its order."""
    least, greatest = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).head()
    rows = tables.generate_rows(t.spark, greatest - least + 1, least, LOADED)
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return rows.join(orders, rows["id"] == orders["o_orderkey"], "inner").drop("o_orderkey")


@query("scan", "S-02", "SELECT * FROM lineitem")
def _(t):
    return tables.scan(t.spark, t.folder, "lineitem")


@query("append_select", "S-04", "SELECT o_orderkey, o_orderdate FROM orders")
def _(t):
    path = new_path(t.spark, "appended")
    cols = ["o_orderkey", "o_orderdate"]
    finished = F.col("o_orderstatus") == "F"
    tables.append_select(t.orders.where(finished), path, cols)
    tables.append_select(t.orders.where(~finished), path, cols)
    return _read(t, path, t.orders.select(*cols))


@query(
    "append_first_rows",
    "S-04",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 12000",
)
def _(t):
    path = new_path(t.spark, "first_rows")
    cols = ["o_orderkey", "o_orderdate"]
    tables.append_select(t.orders, path, cols, limit=12_000, order_by="o_orderkey")
    return _read(t, path, t.orders.select(*cols))


@query(
    "copy_retyped",
    "S-05 F-05",
    """SELECT id, left(display_name, 12) AS display_name, up_votes, views_txt, CAST(views_num AS STRING) AS views_num,
              reputation FROM users_antipattern ORDER BY id LIMIT 100000""",
    views="users_antipattern",
)
def _(t):
    types = {"display_name": "varchar(12)", "views_num": "string"}
    return tables.copy_retyped(t.users_antipattern, types, limit=100_000, key="id")


@query("with_constant_text", "S-06", "SELECT o_orderkey, repeat('ABCDE', 20) AS some_text FROM orders")
def _(t):
    return tables.with_constant_text(t.orders.select("o_orderkey"), "ABCDE", 20)


@query("write_clustered", "S-07", "SELECT * FROM orders")
def _(t):
    path = new_path(t.spark, "clustered")
    tables.write_clustered(t.orders, "o_orderdate", path)
    return _read(t, path, t.orders)


@query("snapshot_table", "S-08 S-09", "SELECT * FROM activity", views="activity")
def _(t):
    path = new_path(t.spark, "snapshots")
    activity = t.activity
    snapshots.create_snapshot_table(activity, path)
    snapshots.append_snapshot(activity.where("collection_time < '2024-01-15'"), path)
    snapshots.append_snapshot(activity.where("collection_time >= '2024-01-15'"), path)
    return snapshots.read_snapshots(t.spark, path, schema=activity.schema)


@query(
    "snapshot_window",
    "S-09 P-23",
    """SELECT * FROM activity
       WHERE collection_time BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
    views="activity",
)
def _(t):
    path = new_path(t.spark, "snapshots")
    activity = t.activity
    snapshots.append_snapshot(activity, path)
    lo, hi = dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 12, 12)
    return snapshots.read_snapshots(t.spark, path, lo, hi, activity.schema)


@query(
    "snapshot_collection_stream",
    "S-09",
    "SELECT event_id, ts AS collection_time, user_id AS session_id, event_type AS status FROM events",
)
def _(t):
    path = new_path(t.spark, "collected")
    stream = sinks.event_stream(t.spark, t.folder, "events", t.events.schema).selectExpr(
        "event_id", "ts AS collection_time", "user_id AS session_id", "event_type AS status"
    )
    snapshots.collect_snapshots(stream, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return snapshots.read_snapshots(t.spark, f"{path}/table", schema=stream.schema)


@query(
    "append_values",
    "S-14",
    """SELECT * FROM supplier
       UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), 'Supplier#A', 0, 0.5), (CAST(-2 AS BIGINT), 'Supplier#B', 1, 1.5))""",
)
def _(t):
    return tables.append_values(t.supplier, [(-1, "Supplier#A", 0, 0.5), (-2, "Supplier#B", 1, 1.5)])


@query(
    "drop_and_create",
    "S-13",
    "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM orders",
)
def _(t):
    path = new_path(t.spark, "recreated")
    tables.append_select(t.orders, path, ["o_orderkey", "o_orderdate"])
    before = t.spark.read.parquet(path)
    count = before.agg(F.count("*").alias("rows_before")).head()[0]
    tables.drop_and_create(t.spark, path, before.schema)
    after = t.spark.read.parquet(path).agg(F.count("*").alias("rows_after"))
    return after.select(F.lit(count).cast("bigint").alias("rows_before"), "rows_after")
