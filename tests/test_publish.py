"""Publication is all or nothing, and a crash in between is repaired."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparktide.sources import publish


@pytest.fixture()
def table(spark, work):
    spark.range(10).write.parquet(work)
    return work


def test_failed_check_rolls_back(spark, table):
    with pytest.raises(publish.PublishAborted):
        publish.change_table(spark, table, lambda df: df.where("id < 0"), lambda df: not df.isEmpty())
    assert spark.read.parquet(table).count() == 10


def test_failed_write_leaves_the_table(spark, table):
    def broken(df):
        return df.select((F.lit(1) / (F.col("id") - 5)).alias("id"))

    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish.change_table(spark, table, broken)
    assert spark.read.parquet(table).count() == 10
    folder = Path(table.removeprefix("file:"))
    assert [p.name for p in folder.parent.iterdir()] == [folder.name]


def test_layout_is_kept_and_files_are_few(spark, work):
    rows = spark.range(0, 1000, 1, 8).withColumn("p", F.col("id") % 2)
    publish.stage_and_publish(rows, work, partition_by=["p"])
    kept = publish.change_table(
        spark, work, lambda df: df.where("id < 20"), partition_by=["p"], compact=True
    )
    assert kept.count() == 20
    assert sorted(f.split("/")[-2] for f in kept.inputFiles()) == ["p=0", "p=1"]


def test_truncate_keeps_the_schema(spark, table):
    assert publish.truncate(spark, table).count() == 0
    assert spark.read.parquet(table).columns == ["id"]


def test_crash_between_the_renames(spark, table):
    files = publish.Files(spark, table)
    files.rename(table, publish._beside(table, "previous"))
    assert publish.exists(spark, table)
    assert spark.read.parquet(table).count() == 10


def test_crash_before_the_cleanup(spark, table):
    spark.range(99).write.parquet(publish._beside(table, "previous"))
    publish.restore(spark, table)
    assert spark.read.parquet(table).count() == 10
    assert not publish.Files(spark, table).exists(publish._beside(table, "previous"))


def test_catalog_table_moves_its_pointer(spark, work):
    spark.sql("DROP TABLE IF EXISTS moved")
    publish.publish_location(spark.range(3), "moved", f"{work}/1")
    publish.publish_location(spark.range(5), "moved", f"{work}/2")
    assert spark.table("moved").count() == 5
    assert spark.read.parquet(f"{work}/1").count() == 3
    spark.sql("DROP TABLE moved")
