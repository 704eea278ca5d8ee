"""Queries of the filter and projection family."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sparktide.operators import predicates as P
from sparktide.plans.registry import query

NUMBERS_500 = list(range(1, 501))
NUMBERS_101 = list(range(1, 102))
DAY = dt.datetime(1997, 1, 15)
SHIP_DAY = dt.datetime(1997, 5, 28)
SENTINEL = dt.datetime(1901, 1, 1)
HOUR = (dt.datetime(2024, 1, 10, 0, 0), dt.datetime(2024, 1, 10, 6, 0))


def _listed(values, quoted: bool = False) -> str:
    return ", ".join(f"'{v}'" if quoted else str(v) for v in values)


@query("select_star_where", "P-01", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    return P.select_star_where(t.customer, F.col("c_mktsegment") == "BUILDING")


@query("project_where", "P-02", "SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(t):
    return P.project_where(t.customer, ["c_name", "c_acctbal"], F.col("c_mktsegment") == "BUILDING")


@query(
    "select_columns_like",
    "P-03",
    """SELECT start_time, blocking_session_id, login_name, collection_time, session_id, status, wait_info,
              cpu_total, tempdb_current, open_tran_count FROM activity""",
    views="activity",
)
def _(t):
    return P.select_columns_like(t.activity, "[start_time][block%][login%][%]")


@query(
    "filter_like_login",
    "P-04 F-12",
    "SELECT collection_time, session_id, login_name FROM activity WHERE login_name LIKE 'login_3%'",
    views="activity",
)
def _(t):
    return P.filter_like(t.activity, "login", "login_3%").select(
        "collection_time", "session_id", "login_name"
    )


@query(
    "filter_like_except",
    "P-05",
    """SELECT collection_time, session_id, login_name FROM activity
       WHERE login_name LIKE 'login%' AND login_name NOT LIKE '%5'""",
    views="activity",
)
def _(t):
    return P.filter_like_except(t.activity, ("login", "login%"), ("login", "%5")).select(
        "collection_time", "session_id", "login_name"
    )


@query(
    "hide_idle_and_system_sessions",
    "P-06",
    """SELECT collection_time, session_id, status FROM activity
       WHERE status <> 'sleeping' AND session_id > 50""",
    views="activity",
)
def _(t):
    return P.include_states(t.activity).select("collection_time", "session_id", "status")


@query(
    "show_idle_and_system_sessions",
    "P-06",
    "SELECT collection_time, session_id, status FROM activity",
    views="activity",
)
def _(t):
    return P.include_states(t.activity, sleeping=2, system=True).select(
        "collection_time", "session_id", "status"
    )


@query("filter_equal_typed", "P-07", "SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#12'")
def _(t):
    return P.filter_equal_typed(t.part.select("p_partkey", "p_brand"), "p_brand", "Brand#12")


@query(
    "filter_unicode_literal",
    "P-08",
    "SELECT c_custkey, c_name FROM customer WHERE c_name = 'Customer#000000042'",
)
def _(t):
    return P.filter_equal_typed(t.customer.select("c_custkey", "c_name"), "c_name", "Customer#000000042")


@query(
    "filter_joined_literal",
    "P-08 F-09",
    "SELECT c_custkey, c_name FROM customer WHERE c_name = 'Customer#' || '000000042'",
)
def _(t):
    return P.filter_joined_literal(t.customer.select("c_custkey", "c_name"), "c_name", "Customer#", "000000042")


@query(
    "filter_suffixed_column",
    "P-08",
    "SELECT c_custkey, c_name FROM customer WHERE c_name || '?' = 'Customer#000000042?'",
)
def _(t):
    return P.filter_suffixed_equals(
        t.customer.select("c_custkey", "c_name"), "c_name", "?", "Customer#000000042?"
    )


@query(
    "count_year_function",
    "P-09 F-01",
    "SELECT count(o_orderkey) AS n FROM orders WHERE year(o_orderdate) = 1997",
)
def _(t):
    return P.count_year_function(t.orders, "o_orderdate", 1997, "o_orderkey")


@query(
    "count_year_between",
    "P-10",
    """SELECT count(event_id) AS n FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 00:00:00'""",
)
def _(t):
    return P.count_year_between(t.events, "ts", 2024, "event_id")


@query(
    "count_until_midnight_between",
    "P-10",
    """SELECT count(event_id) AS n FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00'""",
)
def _(t):
    lo, hi = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 30)
    return P.filter_time_between(t.events, "ts", lo, hi).agg(F.count("event_id").alias("n"))


@query(
    "count_year_half_open",
    "P-11 F-02",
    """SELECT count(event_id) AS n FROM events
       WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2025-01-01 00:00:00'""",
)
def _(t):
    return P.count_year_half_open(t.events, "ts", 2024, "event_id")


@query(
    "count_day_as_text",
    "P-12",
    "SELECT count(event_id) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
)
def _(t):
    return P.count_day_as_text(t.events, "ts", dt.date(2024, 1, 15), "event_id")


@query(
    "count_shifted_date_equals",
    "P-13 F-02 F-04",
    """SELECT count(o_orderkey) AS n FROM orders
       WHERE o_orderdate - INTERVAL 1 YEAR = TIMESTAMP '1997-01-15 00:00:00'""",
)
def _(t):
    return P.count_shifted_date_equals(t.orders, "o_orderdate", DAY, "o_orderkey")


@query(
    "count_shifted_leap_day",
    "P-13",
    """SELECT count(o_orderkey) AS n FROM orders
       WHERE o_orderdate - INTERVAL 1 YEAR = TIMESTAMP '1999-02-28 00:00:00'""",
)
def _(t):
    return P.count_shifted_date_equals(t.orders, "o_orderdate", dt.datetime(1999, 2, 28), "o_orderkey")


@query(
    "count_arith_predicate",
    "P-14 F-13",
    "SELECT count(o_orderkey) AS n FROM orders WHERE o_totalprice - 250000.0 > 0",
)
def _(t):
    return P.count_arith_predicate(t.orders, "o_totalprice", 250_000.0, "o_orderkey")


def _shipped(t):
    return t.orders_nullable.select("o_orderkey", "ship_date")


@query(
    "filter_null_sentinel",
    "P-15 F-07",
    """SELECT o_orderkey, ship_date FROM orders_nullable
       WHERE coalesce(ship_date, TIMESTAMP '1901-01-01') = coalesce(NULL, TIMESTAMP '1901-01-01')""",
    views="orders_nullable",
)
def _(t):
    return P.filter_null_sentinel(_shipped(t), "ship_date", None, SENTINEL)


@query(
    "filter_null_or",
    "P-16 F-17",
    "SELECT o_orderkey, ship_date FROM orders_nullable WHERE ship_date IS NULL",
    views="orders_nullable",
)
def _(t):
    return P.filter_null_or(_shipped(t), "ship_date", None)


@query(
    "filter_null_or_value",
    "P-16",
    "SELECT o_orderkey, ship_date FROM orders_nullable WHERE ship_date = TIMESTAMP '1997-05-28'",
    views="orders_nullable",
)
def _(t):
    return P.filter_null_or(_shipped(t), "ship_date", SHIP_DAY)


@query(
    "filter_null_safe",
    "P-17",
    "SELECT o_orderkey, ship_date FROM orders_nullable WHERE ship_date IS NOT DISTINCT FROM NULL",
    views="orders_nullable",
)
def _(t):
    return P.filter_null_safe(_shipped(t), "ship_date", None)


@query(
    "filter_null_safe_value",
    "P-17",
    """SELECT o_orderkey, ship_date FROM orders_nullable
       WHERE ship_date IS NOT DISTINCT FROM TIMESTAMP '1997-05-28'""",
    views="orders_nullable",
)
def _(t):
    return P.filter_null_safe(_shipped(t), "ship_date", SHIP_DAY)


@query(
    "filter_in_numbers",
    "P-18",
    f"SELECT * FROM users_antipattern WHERE up_votes IN ({_listed(NUMBERS_500)})",
    views="users_antipattern",
)
def _(t):
    return P.filter_in_numbers(t.users_antipattern, "up_votes", NUMBERS_500)


@query(
    "filter_in_table",
    "P-18",
    """SELECT * FROM users_antipattern
       WHERE up_votes IN (SELECT CAST(l_quantity AS INT) FROM lineitem WHERE l_discount > 0.09)""",
    views="users_antipattern",
)
def _(t):
    wanted = t.lineitem.where("l_discount > 0.09").selectExpr("CAST(l_quantity AS INT) AS quantity")
    return P.filter_in_table(t.users_antipattern, "up_votes", wanted)


@query(
    "filter_in_text_vs_numbers",
    "P-19",
    f"SELECT * FROM users_antipattern WHERE CAST(views_txt AS BIGINT) IN ({_listed(range(1, 66))})",
    views="users_antipattern",
)
def _(t):
    return P.filter_in_text_vs_numbers(t.users_antipattern, "views_txt", range(1, 66))


@query(
    "filter_in_text_as_numbers",
    "P-19",
    f"SELECT * FROM users_antipattern WHERE TRY_CAST(views_txt AS BIGINT) IN ({_listed(NUMBERS_500)})",
    views="users_antipattern",
)
def _(t):
    return P.filter_in_text_vs_numbers(t.users_antipattern, "views_txt", NUMBERS_500, numeric=True)


@query(
    "filter_in_text",
    "P-20",
    f"SELECT * FROM users_antipattern WHERE views_txt IN ({_listed(NUMBERS_500, quoted=True)})",
    views="users_antipattern",
)
def _(t):
    return P.filter_in_text(t.users_antipattern, "views_txt", [str(v) for v in NUMBERS_500])


@query(
    "filter_or_chain",
    "P-21",
    "SELECT * FROM users_antipattern WHERE " + " OR ".join(f"views_txt = '{v}'" for v in NUMBERS_101),
    views="users_antipattern",
)
def _(t):
    return P.filter_or_chain(t.users_antipattern, "views_txt", NUMBERS_101)


@query("filter_like_contains", "P-22", "SELECT doc_id, lang FROM documents WHERE text LIKE '%data%'")
def _(t):
    return P.filter_like_contains(t.documents, "text", "data").select("doc_id", "lang")


@query(
    "filter_time_between",
    "P-23",
    """SELECT * FROM activity
       WHERE collection_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 06:00:00'""",
    views="activity",
)
def _(t):
    return P.filter_time_between(t.activity, "collection_time", *HOUR)


@query("filter_optional_given", "P-24", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(t):
    return P.filter_optional(t.orders, "o_orderpriority", "1-URGENT")


@query("filter_optional_absent", "P-24", "SELECT * FROM orders")
def _(t):
    return P.filter_optional(t.orders, "o_orderpriority", None)


@query(
    "filter_two_columns",
    "P-25",
    "SELECT l_orderkey, l_quantity, l_linenumber FROM lineitem WHERE l_quantity + l_linenumber = 40",
)
def _(t):
    cols = t.lineitem.select("l_orderkey", "l_quantity", "l_linenumber")
    return P.filter_two_columns(cols, "l_quantity", "l_linenumber", 40)


@query(
    "filter_column_plus_value",
    "P-25",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber + 3 = 7",
)
def _(t):
    return P.filter_column_plus_value(t.lineitem.select("l_orderkey", "l_linenumber"), "l_linenumber", 3, 7)


@query(
    "filter_case_equals",
    "P-26 F-08",
    """SELECT p_partkey, p_brand, p_size FROM part
       WHERE p_size = CASE WHEN p_brand = 'Brand#12' THEN 10 WHEN p_brand = 'Brand#13' THEN 20 END""",
)
def _(t):
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    cases = [(F.col("p_brand") == "Brand#12", 10), (F.col("p_brand") == "Brand#13", 20)]
    return P.filter_case_equals(parts, "p_size", cases)


@query(
    "filter_not_in",
    "P-27",
    """SELECT collection_time, session_id, login_name FROM activity
       WHERE login_name NOT IN ('login_0', 'login_1')""",
    views="activity",
)
def _(t):
    return P.filter_not_in(t.activity, "login_name", ["login_0", "login_1"]).select(
        "collection_time", "session_id", "login_name"
    )


@query("filter_modulo", "P-28 F-13", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def _(t):
    return P.filter_modulo(t.orders.select("o_orderkey"), "o_orderkey", 2)


@query(
    "filter_binary_equals",
    "P-29",
    "SELECT name, is_disabled FROM principals WHERE principal_id % 256 = 1",
    views="principals",
)
def _(t):
    sid = F.unhex(F.lpad(F.hex(F.col("principal_id") % 256), 2, "0"))
    return P.filter_binary_equals(t.principals.withColumn("sid", sid), "sid", b"\x01").select(
        "name", "is_disabled"
    )


@query(
    "config_value",
    "P-30",
    "SELECT * FROM configurations WHERE name IN ('clr enabled', 'clr strict security', 'xp_cmdshell')",
    views="configurations",
)
def _(t):
    return P.config_value(t.configurations, "clr enabled", "clr strict security", "xp_cmdshell")


@query(
    "parameterised_filter",
    "P-31",
    "SELECT o_orderkey, ship_date FROM orders_nullable WHERE ship_date = TIMESTAMP '1997-05-28'",
    views="orders_nullable",
)
def _(t):
    return P.parameterised(
        t.spark,
        "SELECT o_orderkey, ship_date FROM {shipped} WHERE ship_date <=> CAST(:day AS TIMESTAMP_NTZ)",
        {"day": SHIP_DAY},
        shipped=t.orders_nullable,
    )
