"""Values, patterns, partitions and sums at the edges of their types."""

import datetime as dt

from pyspark.sql import functions as F

from sparktide.functions import conversion, text
from sparktide.operators import activity, ordering, predicates
from sparktide.sources import publish, snapshots
from sparktide.streaming import sinks


def test_fractions_and_times_of_day_equal_nothing(spark):
    rows = spark.createDataFrame([(3, dt.date(2024, 1, 2)), (4, dt.date(2024, 1, 3)), (None, None)], "n int, d date")
    assert predicates.filter_equal_typed(rows, "n", 3.7).count() == 0
    assert predicates.filter_equal_typed(rows, "n", 3.0).count() == 1
    assert predicates.filter_null_safe(rows, "n", 3.7).count() == 0
    assert predicates.filter_null_or(rows, "n", 3.7).count() == 0
    assert predicates.filter_null_sentinel(rows, "n", 3.7, -1).count() == 0
    noon = dt.datetime(2024, 1, 2, 12)
    assert predicates.filter_equal_typed(rows, "d", noon).count() == 0
    assert [r.n for r in predicates.filter_time_between(rows, "d", noon, dt.datetime(2024, 1, 3, 12)).collect()] == [4]


def test_patterns_hold_backslashes_and_sets(spark):
    names = ["CORP\\\\amy", "CORP\\\\bob", "corp\\\\amy", "a1", "b2", "z9", "a^", "[x]", "100%"]
    names = [n.replace("\\\\", "\\") for n in names]
    rows = spark.createDataFrame([(n,) for n in names], "name string")

    def found(pattern, collation=None):
        return {r.name for r in rows.where(text.like(F.col("name"), pattern, collation)).collect()}

    assert found("CORP\\%") == {"CORP\\amy", "CORP\\bob"}
    assert found("CORP\\a%") == {"CORP\\amy"}
    assert found("CORP\\a%", "UTF8_LCASE") == {"CORP\\amy", "corp\\amy"}
    assert found("[a-c]_") == {"a1", "b2", "a^"}
    assert found("[^a-y][0-9]") == {"z9"}
    assert found("[[]x]") == {"[x]"}
    assert found("100%") == {"100%"} and found("100_") == {"100%"}


def test_null_partitions_survive_changes(spark, work):
    rows = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "a"), (5, "b")], "n int, p string")
    rows.write.partitionBy("p").parquet(work)
    publish.change_partitions(spark, work, "p", F.col("n") == 1, lambda df: df.where("n <> 1"))
    assert sorted(r.n for r in spark.read.parquet(work).collect()) == [2, 3, 4, 5]
    publish.change_partitions(spark, work, "p", F.col("n").isin(2, 4), lambda df: df.withColumn("n", F.col("n") + 100))
    assert sorted((r.n, r.p) for r in spark.read.parquet(work).where("p is not null").collect()) == [(5, "b"), (104, "a")]
    assert sorted(r.n for r in spark.read.parquet(work).where("p is null").collect()) == [102, 103]
    publish.change_partitions(spark, work, "p", F.col("p").isNull(), lambda df: df.where("false"))
    assert sorted(r.n for r in spark.read.parquet(work).collect()) == [5, 104]


def test_snapshots_written_and_read_in_different_zones(spark, work):
    moment = dt.datetime(2024, 1, 5, 2, 30)
    spark.createDataFrame([(1,)], "session_id int").withColumn("collection_time", F.lit(moment).cast("timestamp")).transform(
        lambda df: snapshots.append_snapshot(df, work) or df
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        lo, hi = dt.datetime(2024, 1, 4, 21), dt.datetime(2024, 1, 4, 22)
        window = spark.read.parquet(work).where(F.col("collection_time").between(F.lit("2024-01-04 21:00").cast("timestamp"), F.lit("2024-01-04 22:00").cast("timestamp")))
        found = snapshots.read_snapshots(spark, work, "2024-01-04 21:00:00", "2024-01-04 22:00:00")
        assert lo < hi and found.count() == window.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_large_top_n_shuffles_the_first_rows_of_each_task(spark):
    rows = spark.range(0, 40_000, 1, 5).select((F.col("id") * 7919 % 40_009).alias("n"), F.lit(None).cast("int").alias("gone"))
    cut = ordering.first_of_each_task(rows, 1_200, [F.col("gone"), F.col("n").desc()])
    assert cut.count() == 5 * 1_200
    want = [r.n for r in rows.orderBy(F.col("n").desc()).limit(1_200).collect()]
    assert [r.n for r in ordering.top_n(rows, 1_200, F.col("gone"), F.col("n").desc()).collect()] == want
    assert ordering.top_n(rows.where("n < 0"), 1_200, "n").count() == 0


def test_a_large_top_n_is_in_order(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("n"))
    got = [r.n for r in ordering.top_n(rows, 5_000, F.col("n").desc()).collect()]
    assert got == sorted(got, reverse=True) and len(got) == 5_000


def test_recent_events_with_maps_at_any_n(spark):
    rows = spark.createDataFrame([("k", i, {"a": i}) for i in range(1_500)], "key string, n int, m map<string,int>")
    for n in (1_000, 1_001):
        assert sinks.recent_events(rows, n, [F.col("n").desc()], "key").count() == n


def test_sums_beyond_bigint(spark):
    big = 9 * 10**18
    rows = spark.createDataFrame([(1, big), (1, big), (1, big - 2)], "k int, t long")
    mean = rows.agg(conversion.rounded_mean(conversion.wide_sum("t"), F.count("t")).alias("m")).first().m
    assert mean == big - 1
    slow = activity.parameter_sensitivity(rows, "k", "t", 50).first()
    assert (slow.avg_time, slow.slowest_percent) == (big - 1, 100)
