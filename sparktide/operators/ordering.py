"""Sorting, top-k, keyset paging and set operations."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.workspace import materialise

# Spark's own top-k sends this many rows of every task to one final task, which
# is fine up to here; beyond it the rows are cut at a key found by counting.
SMALL_TOP = 1_000

# Cells that quantiles divide the keys into, the accuracy of the quantiles, and the keys
# that one task may sort to end a search.
CUTS = 250
QUANTILE_ACCURACY = 25_000
LEAF_ROWS = 10_000

# monotonically_increasing_id holds the place within a partition in these low bits.
_POSITION_BITS = 33


def sort_columns(spec: str) -> list[Column]:
    """Columns of a ``[name] DESC, [other]`` specification."""
    found = re.findall(r"\[([^\]]+)\]\s*(ASC|DESC)?", spec, re.IGNORECASE)
    return [F.col(c).desc() if way.upper() == "DESC" else F.col(c).asc() for c, way in found]


def sort_by(df: DataFrame, spec: str) -> DataFrame:
    return df.orderBy(*sort_columns(spec))


def order_asc(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending, nulls first."""
    return df.orderBy(*[F.col(c).asc() for c in cols])


def order_desc(df: DataFrame, *cols: str) -> DataFrame:
    """Descending, nulls last."""
    return df.orderBy(*[F.col(c).desc() for c in cols])


def _place() -> Column:
    """The place of a row within its partition, from 0."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "id", start: int = 1, step: int = 1
) -> DataFrame:
    """Consecutive numbers over the whole table in the given order.

    Range partitions are sorted and written, each row knowing its place in its
    own partition; a partition then needs only the number of rows before it.
    No task sees more than one partition, and rows with equal order keys are
    still split over several. Runs two jobs.
    """
    keys = [*order_by, "_tie"]
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumns({"_part": F.spark_partition_id(), "_place": _place()})
    )
    written = materialise(ranged, "ranged")
    # One row per partition, so a single task for the offsets is enough and
    # the table is small enough to send everywhere.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.lit(start) + F.lit(step) * (F.col("_offset") + F.col("_place"))
    return (
        written.join(F.broadcast(offsets), "_part", "inner")
        .withColumn(name, number.cast("bigint"))
        .drop("_part", "_place", "_offset")
    )


def first_of_each_task(df: DataFrame, n: int, by: Sequence[Column | str]) -> DataFrame:
    """At most ``n`` rows of every partition, the first in order: what a top ``n`` can be made of."""
    placed = df.sortWithinPartitions(*by).withColumn("_place", _place())
    return placed.where(F.col("_place") < n).drop("_place")


def top_n(df: DataFrame, n: int, *by: Column | str) -> DataFrame:
    """The first ``n`` rows in order.

    Beyond a small ``n`` by place, so that no task holds them all: every task keeps its
    first ``n`` rows, and only those are shuffled, written and numbered.
    """
    if n <= SMALL_TOP:
        return df.orderBy(*by).limit(n)
    rows = number_rows(first_of_each_task(df, n, by), by, "_row")
    return rows.where(F.col("_row") <= n).orderBy("_row").drop("_row")


def limit_any(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def _countable(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


@dataclass(frozen=True)
class _Place:
    """The n-th smallest key, the rows below it, and those up to and with it."""

    key: object
    below: int
    upto: int


def _key_at(rows: DataFrame, key: str, n: int) -> _Place | None:
    """The ``n``-th smallest key, or the last one; null keys don't count, None without keys.

    One pass takes the number of keys and quantiles at ``CUTS`` places. A second one counts
    around the cell of the wanted place and, in the same job, writes the keys inside, which
    are searched on in the same way: the table is read twice, whatever ``n`` is. The cuts
    themselves are no part of a cell, so a key with very many rows ends the search.
    """
    value, before, want = F.col(key), 0, n
    rows = rows.select(key)
    while True:
        shares = [k / CUTS for k in range(CUTS + 1)]
        size, cuts = rows.agg(F.count(key), F.percentile_approx(key, shares, QUANTILE_ACCURACY)).head()
        if not size:
            return None
        if size <= LEAF_ROWS:
            last = rows.where(value.isNotNull()).orderBy(key).limit(want).agg(F.max(key)).head()[0]
            below, upto = rows.agg(F.count_if(value < F.lit(last)), F.count_if(value <= F.lit(last))).head()
            return _Place(last, before + below, before + upto)
        # Quantiles are off by a hundredth of a cell at most; a cell more on each side holds the place.
        cell = min(CUTS - 1, min(want, size) * CUTS // size)
        a, b = cuts[max(0, cell - 1)], cuts[min(CUTS, cell + 2)]
        want = min(want, size)
        seen = Observation()
        counts = {
            "below_a": F.count_if(value < F.lit(a)), "to_a": F.count_if(value <= F.lit(a)),
            "below_b": F.count_if(value < F.lit(b)), "to_b": F.count_if(value <= F.lit(b)),
        }
        watched = rows.observe(seen, *[count.alias(name) for name, count in counts.items()])
        inside = materialise(watched.where((value > F.lit(a)) & (value < F.lit(b))), "cell")
        n_of = seen.get
        if n_of["below_a"] < want <= n_of["to_a"]:
            return _Place(a, before + n_of["below_a"], before + n_of["to_a"])
        if n_of["below_b"] < want <= n_of["to_b"]:
            return _Place(b, before + n_of["below_b"], before + n_of["to_b"])
        if n_of["to_a"] < want <= n_of["below_b"]:
            rows, before, want = inside, before + n_of["to_a"], want - n_of["to_a"]
        elif want <= n_of["below_a"]:
            rows = rows.where(value < F.lit(a))
        else:
            rows, before, want = rows.where(value > F.lit(b)), before + n_of["to_b"], want - n_of["to_b"]


def nth_key(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The ``n``-th key above ``after``, or the last one if fewer are left.

    One row with column ``nth_key``; null when no key lies above. Found by counting (runs
    jobs); keys that have no quantiles, such as texts, are sorted.
    """
    rows = df.where(F.col(key) > F.lit(after)).select(key)
    if not _countable(df, key):
        return top_n(rows, n, key).agg(F.max(key).alias("nth_key"))
    place = _key_at(rows, key, n)
    schema = T.StructType([T.StructField("nth_key", df.schema[key].dataType)])
    return df.sparkSession.createDataFrame([(place.key if place else None,)], schema)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest non-null keys.

    A comparison with the n-th key, so no task holds the rows. Rows that tie at that key
    are taken in any order, just enough of them.
    """
    keyed = df.where(F.col(key).isNotNull())
    if not _countable(df, key):
        return top_n(keyed, n, key)
    place = _key_at(keyed, key, n) if n > 0 else None
    if place is None:
        return keyed.limit(0)
    if place.upto <= n:
        return df.where(F.col(key) <= F.lit(place.key))
    ties = number_rows(df.where(F.col(key) == F.lit(place.key)), [key], "_row")
    return df.where(F.col(key) < F.lit(place.key)).unionByName(ties.where(F.col("_row") <= n - place.below).drop("_row"))


def intersect_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct common rows; null equals null. Each side is reduced before the shuffle."""
    return left.distinct().intersect(right.distinct())
