"""The physical plans are the ones the operators promise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from sparktide.operators import joins, ordering, predicates
from sparktide.sources import publish, snapshots, tables as source_tables

QUERIES = entry_points.queries()
DAY = dt.datetime(1997, 5, 28)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    lines = [line for line in plan_of(df).splitlines() if "PushedFilters" in line]
    return " ".join(line[line.index("PushedFilters") :].split(", ReadSchema")[0] for line in lines)


def schemas_read(df):
    return [line.split("ReadSchema: ")[1] for line in plan_of(df).splitlines() if "ReadSchema: " in line]


@pytest.mark.parametrize(
    "name,node",
    [
        ("semi_join_in", "LeftSemi"),
        ("anti_join", "LeftAnti"),
        ("privileged_principals", "LeftSemi"),
        ("filter_in_table", "LeftSemi"),
        ("top_n", "TakeOrderedAndProject"),
        ("filter_in_numbers", "INSET"),
        ("filter_or_chain", "INSET"),
    ],
)
def test_node(spark, folder, name, node):
    assert node in plan_of(QUERIES[name](spark, folder))


def test_no_pair_products(spark, folder):
    """No registered join falls back to comparing every pair."""
    for name in ("wide_join", "or_across_tables", "snapshot_blockers", "block_leaders", "aborted_executions",
                 "intersect_rows", "average_time_baseline", "backup_media"):
        plan = plan_of(QUERIES[name](spark, folder))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_the_small_side_is_broadcast(spark, folder):
    """Neither the query texts nor the runs are sent around, but what they are looked up in."""
    for name in ("antipattern_scan", "average_time_baseline", "filter_in_table"):
        assert "BuildLeft" not in plan_of(QUERIES[name](spark, folder)), name


def test_no_python_in_plans(spark, folder):
    for name in ("activity_delta", "antipattern_scan", "aborted_executions", "deadlock_reports_from_xml"):
        plan = plan_of(QUERIES[name](spark, folder))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_query_texts_are_cut_once(spark, folder, tables, monkeypatch):
    """The texts are cut in one place of the plan, by several tasks."""
    from sparktide.operators import antipatterns
    from sparktide.plans import views

    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = plan_of(antipatterns.antipattern_scan(tables.query_log.select("query_id", "query_sql_text"), tables.column_types))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sum("[\\p{L}_][\\p{L}\\p{N}_@#$]*+" in line for line in plan.splitlines()) == 1
    monkeypatch.setattr(views, "TEXTS_PER_TASK", 40)
    log = views.Tables(spark, folder).query_log
    assert log.rdd.getNumPartitions() == -(-log.count() // 40) > 1


def test_year_range_is_pushed(tables):
    assert "GreaterThanOrEqual" in pushed(predicates.filter_year(tables.orders, "o_orderdate", 1997))
    by_function = tables.orders.where(F.year("o_orderdate") == 1997)
    assert "GreaterThanOrEqual" not in pushed(by_function)


def test_day_is_pushed_as_range(tables):
    df = predicates.count_day_as_text(tables.orders, "o_orderdate", DAY.date(), "o_orderkey")
    assert "GreaterThanOrEqual" in pushed(df) and "LessThan" in pushed(df)


@pytest.mark.parametrize(
    "build,expected",
    [
        (lambda t: predicates.count_arith_predicate(t.orders, "o_totalprice", 1000.0, "o_orderkey"), "GreaterThan"),
        (lambda t: predicates.count_shifted_date_equals(t.orders, "o_orderdate", DAY, "o_orderkey"), "EqualTo"),
        (lambda t: predicates.filter_null_safe(t.orders, "o_orderdate", DAY), "EqualNullSafe"),
        (lambda t: predicates.filter_null_or(t.orders, "o_orderdate", None), "IsNull"),
        (lambda t: predicates.filter_equal_typed(t.part, "p_brand", 12), "EqualTo(p_brand,12)"),
        (lambda t: predicates.filter_like_contains(t.documents, "text", "data"), "StringContains"),
        (lambda t: predicates.filter_suffixed_equals(t.customer, "c_name", "?", "a?"), "EqualTo(c_name,a)"),
        (lambda t: predicates.filter_column_plus_value(t.lineitem, "l_linenumber", 3, 7), "EqualTo(l_linenumber,4)"),
        (lambda t: predicates.filter_in_text_vs_numbers(t.part, "p_brand", [1, 2]), "In(p_brand"),
    ],
)
def test_predicate_reaches_the_scan(tables, build, expected):
    assert expected in pushed(build(tables))


def test_only_needed_columns_are_read(spark, folder, tables):
    df = predicates.project_where(tables.customer, ["c_name"], F.col("c_mktsegment") == "BUILDING")
    assert schemas_read(df) == ["struct<c_name:string,c_mktsegment:string>"]
    read = schemas_read(QUERIES["semi_join_in"](spark, folder))
    assert sorted(read) == [
        "struct<l_orderkey:bigint,l_partkey:bigint>",
        "struct<o_orderkey:bigint>",
        "struct<p_partkey:bigint,p_type:string>",
    ]


def test_or_across_tables_filters_both_scans(tables):
    df = joins.or_across_tables(
        tables.customer, tables.orders, "c_custkey", "o_custkey",
        F.col("c_mktsegment") == "BUILDING", F.col("o_orderstatus") == "F",
    )
    assert "EqualTo(c_mktsegment,BUILDING)" in pushed(df)
    assert "EqualTo(o_orderstatus,F)" in pushed(df)


def test_semi_join_shuffles_distinct_keys(spark, tables):
    """The child keys are reduced before the exchange, and the join adds no exchange of its own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            joins.semi_join_in(tables.orders.select("o_orderkey"), tables.lineitem, "o_orderkey", "l_orderkey")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    lines = plan.splitlines()
    exchange = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line)
    assert "HashAggregate" in lines[exchange + 1]


def test_far_key_is_not_sorted_whole(tables, monkeypatch):
    monkeypatch.setattr(ordering, "LEAF_ROWS", 50)
    df = ordering.first_rows(tables.orders, "o_orderkey", 1000)
    assert "Sort" not in plan_of(df) and "TakeOrdered" not in plan_of(df)
    assert df.count() == 1000
    # Keys that tie at the cut are numbered among themselves only.
    plan = plan_of(ordering.first_rows(tables.lineitem, "l_orderkey", 3000))
    assert "Sort [l_orderkey" not in plan and "TakeOrdered" not in plan


def test_snapshot_window_prunes_partitions(spark, tables, work):
    snap = tables.activity
    snapshots.append_snapshot(snap, work)
    lo, hi = dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 11, 12)
    df = snapshots.read_snapshots(spark, work, lo, hi, snap.schema)
    scan = next(line for line in plan_of(df).splitlines() if "PartitionFilters" in line)
    assert "collection_date" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_clustered_files_hold_ranges(spark, tables, work):
    """Row groups of a clustered table cover disjoint key ranges, so a range skips most of them."""
    import pyarrow.parquet as pq
    from pathlib import Path

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        source_tables.write_clustered(tables.orders, "o_orderdate", work)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = []
    for file in Path(work.removeprefix("file:")).glob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        column = footer.schema.names.index("o_orderdate")
        for group in range(footer.num_row_groups):
            stats = footer.row_group(group).column(column).statistics
            ranges.append((stats.min, stats.max))
    ranges.sort()
    assert len(ranges) > 1
    assert all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:]))


def test_partition_update_leaves_other_files(spark, tables, work):
    by_year = tables.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    by_year.write.partitionBy("y").parquet(work)
    before = set(spark.read.parquet(work).inputFiles())
    publish.change_partitions(
        spark, work, "y", F.col("y") == 1997, lambda df: df.withColumn("o_orderkey", F.col("o_orderkey") + 0)
    )
    after = set(spark.read.parquet(work).inputFiles())
    changed = {f for f in before ^ after}
    assert changed and all("y=1997" in f for f in changed)


def test_partition_delete_removes_emptied_folders(spark, work):
    """Also with a partition value that is encoded in its folder name."""
    rows = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c/d"), (4, "e")], "k int, p string")
    rows.write.partitionBy("p").parquet(work)
    doomed = (F.col("p") == "a b") | (F.col("k") == 3)
    publish.change_partitions(spark, work, "p", doomed, lambda df: df.where(~doomed))
    assert [tuple(r) for r in spark.read.parquet(work).collect()] == [(4, "e")]
