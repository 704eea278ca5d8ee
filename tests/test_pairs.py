"""Pairs of formulations that must return the same rows, duplicates included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from sparktide.operators import joins, mutations, predicates

QUERIES = entry_points.queries()

PAIRS = [
    ("distinct_join", "semi_join_in"),
    ("wide_join", "staged_join"),
    ("anti_join_left_null", "anti_join"),
    ("or_filter_across_tables", "or_across_tables"),
    ("filter_null_sentinel", "filter_null_or"),
    ("filter_null_or", "filter_null_safe"),
    ("filter_null_or_value", "filter_null_safe_value"),
    ("filter_null_safe_value", "parameterised_filter"),
    ("filter_unicode_literal", "filter_joined_literal"),
    ("filter_unicode_literal", "filter_suffixed_column"),
    ("delete_in_batches", "delete_via_view"),
]


@pytest.mark.parametrize("first,second", PAIRS)
def test_pair(spark, folder, assert_same, first, second):
    assert_same(QUERIES[first](spark, folder), QUERIES[second](spark, folder))


def test_delete_equals_keep(tables, assert_same):
    orders = tables.orders
    deleted = mutations.delete_where(orders, F.col("o_orderkey") > 300)
    assert_same(deleted, mutations.keep_by_rewrite(orders, F.col("o_orderkey") <= 300))


def test_year_forms_agree_on_midnights(tables):
    args = (tables.orders, "o_orderdate", 1997, "o_orderkey")
    by_function = predicates.count_year_function(*args).head()[0]
    assert predicates.count_year_half_open(*args).head()[0] == by_function
    assert predicates.count_year_between(*args).head()[0] == by_function


def test_exists_intersect_equals_null_safe(spark, tables, assert_same):
    shipped = tables.orders_nullable.select("o_orderkey", "ship_date")
    text = """SELECT o_orderkey, ship_date FROM {shipped}
              WHERE EXISTS (SELECT ship_date INTERSECT SELECT CAST(:day AS TIMESTAMP_NTZ))"""
    for day in (None, dt.datetime(1997, 5, 28)):
        literal = spark.sql(text, args={"day": day}, shipped=shipped)
        assert_same(literal, predicates.filter_null_safe(shipped, "ship_date", day))


def test_lists_of_any_length_mean_the_same(spark):
    rows = spark.createDataFrame([(1, 1.0, 1, "1"), (7, 7.5, 7, "7"), (None, None, None, None)], "a int, b double, c smallint, d string")
    for n in (10, 10_001, 20_000):
        values = list(range(2, n)) + [40_000]
        assert predicates.filter_in_numbers(rows, "a", values).count() == 1
        assert predicates.filter_in_numbers(rows, "b", values).count() == 0
        assert predicates.filter_in_numbers(rows, "c", values).count() == 1
        assert predicates.filter_in_text(rows, "d", [str(v) for v in values]).count() == 1


def test_or_across_keeps_rows_with_null_predicate(spark, assert_same):
    left = spark.createDataFrame([(1, None), (2, "1"), (3, "9")], "id int, views string")
    right = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (3, 5)], "user_id int, seen int")
    pl, pr = F.col("views") == "1", F.col("seen") == 5
    direct = joins.or_filter_across_tables(left, right, "id", "user_id", pl | pr)
    assert_same(joins.or_across_tables(left, right, "id", "user_id", pl, pr), direct)
