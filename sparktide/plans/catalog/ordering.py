"""Queries of the sort, limit, paging, set and scalar-function families."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparktide.functions import conversion, temporal, text
from sparktide.operators import ordering as O
from sparktide.plans.registry import query


@query(
    "top_n",
    "O-01",
    "SELECT id, reputation FROM users_antipattern ORDER BY reputation, id LIMIT 1000",
    views="users_antipattern",
)
def _(t):
    return O.top_n(t.users_antipattern.select("id", "reputation"), 1000, "reputation", "id")


@query(
    "limit_any",
    "O-02",
    "SELECT count(*) AS n FROM (SELECT * FROM users_antipattern LIMIT 1000) s",
    views="users_antipattern",
)
def _(t):
    return O.limit_any(t.users_antipattern, 1000).agg(F.count("*").alias("n"))


@query(
    "sort_by",
    "O-03",
    """SELECT collection_time, session_id, login_name FROM activity
       ORDER BY login_name DESC, collection_time, session_id""",
    views="activity",
)
def _(t):
    rows = t.activity.select("collection_time", "session_id", "login_name")
    return O.sort_by(rows, "[login_name] DESC, [collection_time], [session_id]")


@query(
    "order_ascending",
    "O-04",
    "SELECT o_orderkey, ship_date FROM orders_nullable ORDER BY ship_date NULLS FIRST, o_orderkey",
    views="orders_nullable",
)
def _(t):
    return O.order_asc(t.orders_nullable.select("o_orderkey", "ship_date"), "ship_date", "o_orderkey")


@query(
    "order_descending",
    "O-04",
    "SELECT lsn, operation FROM change_log ORDER BY lsn DESC",
    views="change_log",
)
def _(t):
    return O.order_desc(t.change_log.select("lsn", "operation"), "lsn")


@query(
    "nth_key",
    "O-05",
    """SELECT max(o_orderkey) AS nth_key FROM (
         SELECT o_orderkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500) b""",
)
def _(t):
    return O.nth_key(t.orders, "o_orderkey", 1000, 500)


@query(
    "nth_key_far",
    "O-05",
    """SELECT max(l_orderkey) AS nth_key FROM (
         SELECT l_orderkey FROM lineitem WHERE l_orderkey > 100 ORDER BY l_orderkey LIMIT 20000) b""",
)
def _(t):
    return O.nth_key(t.lineitem, "l_orderkey", 100, 20_000)


@query(
    "intersect_rows",
    "T-01",
    "SELECT ship_date FROM orders_nullable INTERSECT SELECT ship_date FROM orders_nullable WHERE o_totalprice < 50000",
    views="orders_nullable",
)
def _(t):
    dates = t.orders_nullable
    return O.intersect_rows(dates.select("ship_date"), dates.where("o_totalprice < 50000").select("ship_date"))


@query(
    "date_functions",
    "F-01 F-02 F-03 F-04",
    """SELECT event_id, year(ts) AS event_year, ts + INTERVAL 1 YEAR AS next_year,
              date_diff('second', TIMESTAMP '2024-01-01', ts) AS seconds_passed,
              date_diff('millisecond', TIMESTAMP '2024-01-01', ts) AS millis_passed FROM events""",
)
def _(t):
    as_of = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        temporal.year_of(F.col("ts")).cast("bigint").alias("event_year"),
        temporal.shift_years(F.col("ts"), 1).alias("next_year"),
        temporal.boundaries_between("second", as_of, F.col("ts")).alias("seconds_passed"),
        temporal.boundaries_between("millisecond", as_of, F.col("ts")).alias("millis_passed"),
    )


@query(
    "text_functions",
    "F-09 F-10 F-11 F-12 F-05",
    """SELECT p_partkey, p_name || ' ' || p_type AS label, repeat('ABCDE', 20) AS filler,
              replace(p_name, ' ', '_') AS object_name, left(p_name, 4) AS short_name,
              CASE WHEN p_name LIKE '%ring%' THEN 1 ELSE 0 END AS has_ring FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        text.joined(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("label"),
        text.repeated("ABCDE", 20).alias("filler"),
        text.replaced(F.col("p_name"), " ", "_").alias("object_name"),
        text.first_chars(F.col("p_name"), 4).alias("short_name"),
        F.when(text.like(F.col("p_name"), "%ring%"), 1).otherwise(0).alias("has_ring"),
    )


@query(
    "null_functions",
    "F-07 F-14 F-17",
    """SELECT o_orderkey, coalesce(ship_date, TIMESTAMP '1901-01-01') AS shown,
              ship_date IS NULL AS is_open, 100 // nullif(o_orderkey % 4, 0) AS ratio FROM orders_nullable""",
    views="orders_nullable",
)
def _(t):
    fallback = F.lit(dt.datetime(1901, 1, 1)).cast("timestamp_ntz")
    return t.orders_nullable.select(
        "o_orderkey",
        conversion.null_to(F.col("ship_date"), fallback).alias("shown"),
        F.col("ship_date").isNull().alias("is_open"),
        conversion.whole_division(F.lit(100), F.nullif(F.col("o_orderkey") % 4, F.lit(0))).alias("ratio"),
    )


@query(
    "cast_functions",
    "F-05 F-08 F-13",
    """SELECT o_orderkey, CAST(o_orderkey AS STRING) AS key_text, CAST(trunc(o_totalprice) AS BIGINT) AS whole_price,
              o_orderkey // 7 AS sevens, o_orderkey % 7 AS left_over,
              CASE WHEN o_orderkey > 9999 THEN '*' ELSE CAST(o_orderkey AS STRING) END AS narrow,
              CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Other' END AS state
       FROM orders""",
)
def _(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        key.cast("string").alias("key_text"),
        F.col("o_totalprice").cast("bigint").alias("whole_price"),
        conversion.whole_division(key, F.lit(7)).alias("sevens"),
        (key % 7).alias("left_over"),
        conversion.text_of_width(key, 4).alias("narrow"),
        conversion.first_match(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}, "Other").alias("state"),
    )
