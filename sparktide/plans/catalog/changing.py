"""Queries of the table-change family: a copy is written, changed, published, read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparktide.operators import history, ordering
from sparktide.operators import mutations as M
from sparktide.plans.registry import query
from sparktide.sources import publish
from sparktide.workspace import new_path

STAMP = dt.datetime(2024, 2, 1)
AFTER, BATCH = 2_000, 1_500
COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate"]


def _copy(t, label: str, source=None) -> str:
    path = new_path(t.spark, label)
    (t.orders.select(*COLUMNS) if source is None else source).write.parquet(path)
    return path


def _by_year(t):
    path = new_path(t.spark, "by_year")
    by_year = t.orders.select(*COLUMNS, F.year("o_orderdate").cast("bigint").alias("order_year"))
    by_year.hint("rebalance", "order_year").write.partitionBy("order_year").parquet(path)
    return path, by_year


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


@query("update_all", "M-01", "SELECT o_orderkey, o_custkey, TIMESTAMP '2024-02-01' AS o_orderdate FROM orders")
def _(t):
    path = _copy(t, "update_all")
    return publish.change_table(t.spark, path, lambda df: M.update_all(df, "o_orderdate", _stamp()))


@query(
    "update_where",
    "M-02 P-28",
    """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderkey % 2 = 0 AND o_orderkey BETWEEN 1 AND 4000 THEN TIMESTAMP '2024-02-01'
                   ELSE o_orderdate END AS o_orderdate FROM orders""",
)
def _(t):
    path = _copy(t, "update_where")
    even = (F.col("o_orderkey") % 2 == 0) & F.col("o_orderkey").between(1, 4000)
    return publish.change_table(
        t.spark, path, lambda df: M.update_where(df, even, "o_orderdate", _stamp())
    )


@query(
    "update_partitions",
    "M-02",
    """SELECT o_orderkey, o_custkey, year(o_orderdate) AS order_year,
              CASE WHEN year(o_orderdate) = 1997 AND o_orderkey % 2 = 0 THEN TIMESTAMP '2024-02-01'
                   ELSE o_orderdate END AS o_orderdate FROM orders""",
)
def _(t):
    path, by_year = _by_year(t)
    target = (F.col("order_year") == 1997) & (F.col("o_orderkey") % 2 == 0)
    publish.change_partitions(
        t.spark, path, "order_year", target, lambda df: M.update_where(df, target, "o_orderdate", _stamp())
    )
    return t.spark.read.schema(by_year.schema).parquet(path)


@query(
    "delete_partitions",
    "M-03",
    """SELECT o_orderkey, o_custkey, year(o_orderdate) AS order_year, o_orderdate FROM orders
       WHERE NOT (year(o_orderdate) = 1998 OR year(o_orderdate) = 1997 AND o_orderkey > 100)""",
)
def _(t):
    """One partition goes altogether, one in part, the others are not opened."""
    path, by_year = _by_year(t)
    year = F.col("order_year")
    doomed = (year == 1998) | ((year == 1997) & (F.col("o_orderkey") > 100))
    publish.change_partitions(t.spark, path, "order_year", doomed, lambda df: M.delete_where(df, doomed))
    return t.spark.read.schema(by_year.schema).parquet(path)


@query(
    "delete_where",
    "M-03",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE NOT (o_orderkey > 3000)",
)
def _(t):
    path = _copy(t, "delete_where")
    return publish.change_table(
        t.spark, path, lambda df: M.delete_where(df, F.col("o_orderkey") > 3000), compact=True
    )


@query(
    "delete_null_predicate",
    "M-03",
    """SELECT o_orderkey, ship_date FROM orders_nullable
       WHERE NOT coalesce(ship_date > TIMESTAMP '1998-01-01', false)""",
    views="orders_nullable",
)
def _(t):
    path = _copy(t, "delete_null", t.orders_nullable.select("o_orderkey", "ship_date"))
    late = F.col("ship_date") > F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    return publish.change_table(t.spark, path, lambda df: M.delete_where(df, late))


@query(
    "delete_in_batches",
    "M-04",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey <= 2000",
)
def _(t):
    path = _copy(t, "batched")
    return publish.change_table(
        t.spark, path, lambda df: M.delete_in_batches(df, "o_orderkey", AFTER, BATCH)[0]
    )


@query(
    "delete_batch_log",
    "M-04 O-05",
    """SELECT CAST((r - 1) // 1500 + 1 AS BIGINT) AS batch_no, min(o_orderkey) AS min_key,
              max(o_orderkey) AS max_key, count(*) AS n_rows
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders WHERE o_orderkey > 2000) s
       GROUP BY (r - 1) // 1500""",
)
def _(t):
    return M.batch_log(t.orders, "o_orderkey", AFTER, BATCH)


@query(
    "delete_batch_log_of_repeated_keys",
    "M-04",
    """WITH RECURSIVE k AS (
         SELECT l_orderkey AS key, CAST(sum(count(*)) OVER (ORDER BY l_orderkey) AS BIGINT) AS upto FROM lineitem
         WHERE l_orderkey > 2000 GROUP BY l_orderkey
       ), t AS (SELECT max(upto) AS total FROM k),
       b AS (
         SELECT CAST(1 AS BIGINT) AS batch_no, CAST(0 AS BIGINT) AS s, min(upto) AS e FROM k, t WHERE upto >= least(1500, total)
         UNION ALL
         SELECT b.batch_no + 1, b.e, min(k.upto) FROM b, k, t
         WHERE b.e < t.total AND k.upto >= least(b.e + 1500, t.total) GROUP BY b.batch_no, b.e)
       SELECT batch_no, (SELECT min(key) FROM k WHERE upto > s) AS min_key, (SELECT key FROM k WHERE upto = e) AS max_key,
              e - s AS n_rows FROM b WHERE e IS NOT NULL""",
)
def _(t):
    return M.batch_log(t.lineitem, "l_orderkey", AFTER, BATCH)


@query(
    "next_batch_view",
    "M-05",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey > 2000 ORDER BY o_orderkey LIMIT 1500",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    M.next_batch_view(rows, "o_orderkey", AFTER, BATCH, "orders_to_delete")
    return t.spark.table("orders_to_delete")


@query(
    "delete_via_view",
    "M-05",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey <= 2000",
)
def _(t):
    path = _copy(t, "via_view")
    return publish.change_table(t.spark, path, lambda df: M.delete_via_view(df, "o_orderkey", AFTER))


@query(
    "assign_identity",
    "M-06",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_orderdate FROM orders""",
)
def _(t):
    return M.assign_identity(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query(
    "assign_identity_keeping",
    "M-06",
    """SELECT o_orderkey AS id, o_orderkey, given FROM (
         SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS given FROM orders) g
       WHERE given IS NOT NULL
       UNION ALL
       SELECT (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 2 = 0)
                + row_number() OVER (ORDER BY o_orderkey), o_orderkey, NULL
       FROM orders WHERE o_orderkey % 2 = 1""",
)
def _(t):
    rows = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS given")
    return M.assign_identity(rows, ["o_orderkey"], keep="given")


@query(
    "keep_by_rewrite",
    "M-07",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey <= 1000",
)
def _(t):
    path = _copy(t, "keep")
    return publish.change_table(
        t.spark, path, lambda df: M.keep_by_rewrite(df, F.col("o_orderkey") <= 1000), compact=True
    )


@query(
    "truncate_table",
    "M-08",
    "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM orders",
)
def _(t):
    path = _copy(t, "truncated")
    before = t.spark.read.parquet(path).agg(F.count("*").alias("n")).head()["n"]
    after = publish.truncate(t.spark, path).agg(F.count("*").alias("rows_after"))
    return after.select(F.lit(before).cast("bigint").alias("rows_before"), "rows_after")


@query(
    "publish_or_roll_back",
    "M-09",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey % 2 = 1",
)
def _(t):
    """A delete that passes its check, then one that fails it and leaves the table alone."""
    path = _copy(t, "transaction")

    def not_empty(df):
        return df.limit(1).count() == 1

    even, every = F.col("o_orderkey") % 2 == 0, F.lit(True)
    publish.change_table(t.spark, path, lambda df: M.delete_where(df, even), not_empty)
    try:
        publish.change_table(t.spark, path, lambda df: M.delete_where(df, every), not_empty)
    except publish.PublishAborted:
        pass
    return t.spark.read.parquet(path)


@query(
    "unforce_plans",
    "M-10",
    """SELECT plan_id, query_id, CASE WHEN query_id = 780 AND plan_id = 3 THEN 0 ELSE is_forced_plan END
                AS is_forced_plan FROM qs_plan""",
    views="qs_plan",
)
def _(t):
    plans = t.qs_plan.select("plan_id", "query_id", "is_forced_plan")
    path = _copy(t, "plans", plans)
    return publish.change_table(t.spark, path, lambda df: history.unforce_plans(df, 780, 3))


@query(
    "expire_history",
    "D-05 M-03",
    "SELECT * FROM qs_query WHERE last_execution_time >= TIMESTAMP '2001-09-02'",
    views="qs_query",
)
def _(t):
    path = _copy(t, "history", t.qs_query)
    return publish.change_table(
        t.spark, path, lambda df: history.expire_history(df, dt.datetime(2001, 10, 2), 30)
    )


@query(
    "keyset_page",
    "O-05",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= (
         SELECT max(o_orderkey) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey > 1000
                                      ORDER BY o_orderkey LIMIT 700) b)""",
)
def _(t):
    last = ordering.nth_key(t.orders, "o_orderkey", 1000, 700).head()[0]
    page = F.col("o_orderkey").between(1001, last)
    return t.orders.where(page).select("o_orderkey", "o_orderdate")
