"""Changes to whole tables, expressed as the table that results.

Files are immutable, so a change is a rewrite. The functions here build the
new content; ``sources.publish`` puts it in place of the old.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktide.operators import ordering
from sparktide.workspace import materialise

# Rows of a table whose batches one task looks up; a key counts with one entry, however many rows it has.
BLOCK_ROWS = 1_000_000


def update_all(df: DataFrame, col: str, value: Column) -> DataFrame:
    return df.withColumn(col, value.cast(df.schema[col].dataType))


def update_where(df: DataFrame, predicate: Column, col: str, value: Column) -> DataFrame:
    """One pass instead of a call per row; a null predicate changes nothing."""
    return df.withColumn(
        col, F.when(predicate, value.cast(df.schema[col].dataType)).otherwise(F.col(col))
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that stay; a null predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def keep_by_rewrite(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows to keep, stated as such: the cheap way to delete most of a table."""
    return df.where(predicate)


def assign_identity(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "id",
    start: int = 1,
    step: int = 1,
    keep: str | None = None,
) -> DataFrame:
    """Give each row a number; rows with a value in column ``keep`` retain it.

    Assigned numbers continue after the largest retained one.
    """
    if keep is None:
        return ordering.number_rows(df, order_by, name, start, step)
    given = df.where(F.col(keep).isNotNull()).withColumn(name, F.col(keep).cast("bigint"))
    top = given.agg(F.max(name)).head()[0]
    first = start if top is None else max(start, top + step)
    fresh = ordering.number_rows(df.where(F.col(keep).isNull()), order_by, name, first, step)
    return given.unionByName(fresh)


def _summed_keys(doomed: DataFrame) -> DataFrame:
    """(key, front, upto), written: rows in front of each key, and up to and with it."""
    counted = doomed.groupBy("key").agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.sum("n").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("sum", F.sum("n").over(inside)).join(F.broadcast(offsets), "part")
    upto = F.col("offset") + F.col("sum")
    return materialise(summed.select("key", (upto - F.col("n")).alias("front"), upto.alias("upto")), "keys")


def _walked(ends: DataFrame, entries: DataFrame, n: int, total: int, rows: int, every: bool) -> DataFrame:
    """(start, at): where batches that start at ``entries`` (start, block) lead within their block of ``ends`` (upto, block).

    ``at`` is the last end that the walk meets in the block; with ``every`` there is a row
    per batch on the way.
    """

    def walk(key, left: pa.Table, right: pa.Table) -> pa.Table:
        upto, starts = np.sort(left.column("upto").to_numpy()), right.column("start").to_numpy()
        if not len(starts):
            return pa.table({"start": pa.array([], pa.int64()), "at": pa.array([], pa.int64())})
        wanted = np.minimum(upto + n, total)
        stays = (upto < total) & ((wanted - 1) // rows == key[0].as_py())
        after = np.where(stays, np.searchsorted(upto, wanted), np.arange(len(upto)))
        met = np.searchsorted(upto, np.minimum(starts + n, total))
        if not every:
            while ((further := after[after]) != after).any():
                after = further
            return pa.table({"start": starts, "at": upto[after[met]]})
        # The batches of a table enter a block once.
        made = []
        for start, i in zip(starts.tolist(), met.tolist(), strict=True):
            made.append((start, upto[i]))
            while stays[i]:
                start, i = upto[i], after[i]
                made.append((start, upto[i]))
        return pa.table(np.array(made, np.int64).T.tolist(), names=["start", "at"])

    return ends.groupBy("block").cogroup(entries.groupBy("block")).applyInArrow(walk, "start long, at long")


def batch_log(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The batches a keyset delete of ``n`` rows at a time goes through.

    One row per batch: number, first and last key, rows. A batch takes every row up to the
    key of its n-th row, so equal keys are never split. The keys are cut into blocks of
    ``BLOCK_ROWS`` rows of the table. Only the keys that a batch may leave a block from take
    part in the rounds, whose number grows with the logarithm of the number of blocks; the
    batches inside the blocks are then listed block by block.
    """
    if n < 1:
        raise ValueError("a batch has one row at least")
    doomed = df.where(F.col(key) > F.lit(after)).select(F.col(key).alias("key"))
    keys = _summed_keys(doomed)
    total, rows = keys.agg(F.max("upto")).head()[0] or 0, BLOCK_ROWS

    def block(rank: Column) -> Column:
        return F.floor((rank - 1) / F.lit(rows))

    # A batch that starts behind row s ends with the key of row s + n, in whose block it is looked up.
    def entered(starts: DataFrame) -> DataFrame:
        return starts.select("start", block(F.least(F.col("start") + n, F.lit(total))).alias("block"))

    # A key is in every block that its rows are in.
    ends = keys.select("upto", F.explode(F.sequence(block(F.col("front") + 1), block(F.col("upto")))).alias("block"))
    zero = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("start")).where(F.lit(total > 0))
    leaving = block(F.least(F.col("upto") + n, F.lit(total))) > block(F.col("front") + 1)
    leaves = keys.where((F.col("upto") < total) & leaving).select(F.col("upto").alias("start"))
    steps = materialise(_walked(ends, entered(leaves.union(zero)), n, total, rows, every=False), "batch_steps")
    # From each of these one step is known; those that the first batch leads to are found by doubling.
    state = materialise(steps.withColumn("met", F.col("start") == 0), "batches_met")
    while not state.where(F.col("at") < total).isEmpty():
        sent = state.where("met").select(F.col("at").alias("start"), F.lit(True).alias("hit"))
        ahead = state.select(F.col("start").alias("at"), F.col("at").alias("further"))
        moved = state.join(sent, "start", "left").join(ahead, "at", "left")
        state = materialise(
            moved.select("start", F.coalesce("further", "at").alias("at"), (F.col("met") | F.coalesce("hit", F.lit(False))).alias("met")), "batches_met"
        )
    cuts = _walked(ends, entered(state.where("met")), n, total, rows, every=True)
    cuts = ordering.number_rows(cuts, ["start"], "batch_no")
    first = keys.select(F.col("front").alias("start"), F.col("key").alias("min_key"))
    last = keys.select(F.col("upto").alias("at"), F.col("key").alias("max_key"))
    named = cuts.join(first, "start").join(last, "at")
    return named.select("batch_no", "min_key", "max_key", (F.col("at") - F.col("start")).alias("n_rows"))


def delete_in_batches(df: DataFrame, key: str, after, n: int) -> tuple[DataFrame, DataFrame]:
    """Rows that stay after all batches, and the log of the batches.

    All batches together remove every key above ``after``: the table is
    rewritten once, not once per batch.
    """
    return delete_where(df, F.col(key) > F.lit(after)), batch_log(df, key, after, n)


def next_batch_view(df: DataFrame, key: str, after, n: int, name: str) -> DataFrame:
    """A named view of the next ``n`` rows above ``after``."""
    view = ordering.first_rows(df.where(F.col(key) > F.lit(after)), key, n)
    view.createOrReplaceTempView(name)
    return view


def delete_via_view(df: DataFrame, key: str, after) -> DataFrame:
    """What is left when the view has been emptied until nothing refills it."""
    return delete_where(df, F.col(key) > F.lit(after))
