"""Neighbouring rows under keys of any size.

A window puts all rows of a key into one task. Here the order is cut into
slices (a day, a block of ids) and each (key, slice) is its own window. Only
the first row of a slice has its neighbour elsewhere: the first and last rows
of all slices, two per slice, go through a second window over the key. The
result is that of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, str],
    slice_by: Column,
    ahead: bool = False,
) -> DataFrame:
    """``lag`` (or ``lead`` when ``ahead``) of several columns by one row.

    ``values`` maps new column to source column. ``slice_by`` must rise with
    ``order``; the order must be unique within a key. Inner rows and edge rows
    are read from the same shuffle, so ``df`` is computed once.
    """
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("_slice", *order)
    step = F.lead if ahead else F.lag
    payload = F.struct(*[F.col(source).alias(name) for name, source in values.items()])

    rows = df.withColumn("_slice", slice_by).withColumns(
        {
            "_near": step(payload).over(within),
            "_first": F.lag(F.lit(1)).over(within).isNull(),
            "_last": F.lead(F.lit(1)).over(within).isNull(),
        }
    )
    is_edge = F.col("_first") | F.col("_last")
    alone = F.col("_last") if ahead else F.col("_first")
    edges = rows.where(is_edge).withColumn(
        "_near", F.when(alone, step(payload).over(across)).otherwise(F.col("_near"))
    )
    joined = rows.where(~is_edge).unionByName(edges)
    found = {name: F.col("_near")[name] for name in values}
    return joined.withColumns(found).drop("_slice", "_near", "_first", "_last")
