"""Joins in the form Spark plans best.

No join carries a hint: the side to broadcast is Spark's choice from file and
shuffle sizes, and AQE splits a hot key of the probed side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktide.workspace import materialise


def inner_chain(frames: Sequence[DataFrame], keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Join frames left to right; ``keys[i]`` pairs a column so far with one of frame i+1."""
    joined = frames[0]
    for frame, (left, right) in zip(frames[1:], keys, strict=True):
        joined = joined.join(frame, F.col(left) == frame[right], "inner")
    return joined


def distinct_join(
    parent: DataFrame, child: DataFrame, lookup: DataFrame, keys, parent_key: str
) -> DataFrame:
    """Join through, then remove the duplicates the join made."""
    return inner_chain([parent, child, lookup], keys).select(parent_key).distinct()


def semi_join_in(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parents that have a child: no duplicates of a parent arise, so none are removed.

    The child keys are reduced to distinct ones before they are shuffled, so
    neither many children per parent nor one parent with very many cost more.
    ``parent_key`` is the parent's own key; for a column in which one value
    may fill much of the table use ``predicates.filter_in_table``.
    """
    keys = child.select(child_key).distinct()
    return parent.join(keys, parent[parent_key] == keys[child_key], "left_semi")


def wide_join(frames, keys, predicate: Column, cols: Sequence[str]) -> DataFrame:
    """One statement over all tables; duplicates stay."""
    return inner_chain(frames, keys).where(predicate).select(*cols)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a sub-result once and name it as a view (runs a job).

    The written files give the next join an exact size to plan from.
    """
    staged = materialise(df, name)
    staged.createOrReplaceTempView(name)
    return staged


def staged_join(
    facts: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]], cols: Sequence[str]
) -> DataFrame:
    """Facts against sub-results that were filtered before.

    ``dimensions`` holds (sub-result, fact column, its column).
    """
    for frame, left, right in dimensions:
        facts = facts.join(frame, F.col(left) == frame[right], "inner")
    return facts.select(*cols)


def anti_join_left_null(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Outer join and keep the unmatched: every match is built before it is dropped."""
    marked = right.select(F.col(right_key).alias("_right_key")).distinct()
    joined = left.join(marked, left[left_key] == marked["_right_key"], "left")
    return joined.where(F.col("_right_key").isNull()).drop("_right_key")


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` without a partner; the partner keys are reduced first.

    ``left_key`` is the key of ``left``; where its values repeat very often,
    ``stage`` the distinct partner keys first so that AQE can split them.
    """
    keys = right.select(right_key).distinct()
    return left.join(keys, left[left_key] == keys[right_key], "left_anti")


def or_across_tables(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_predicate: Column,
    right_predicate: Column,
) -> DataFrame:
    """Join where one predicate holds on the left table or another on the right.

    Two joins of filtered inputs, made disjoint by the left predicate, so each
    filter reaches its scan and nothing needs deduplication.
    """
    holds = F.coalesce(left_predicate, F.lit(False))
    on = F.col(left_key) == F.col(right_key)
    by_left = left.where(left_predicate).join(right, on, "inner")
    by_right = left.where(~holds).join(right.where(right_predicate), on, "inner")
    return by_left.unionByName(by_right)


def or_filter_across_tables(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, predicate: Column
) -> DataFrame:
    """The direct form: the whole join is built, then the OR is tested."""
    return left.join(right, F.col(left_key) == F.col(right_key), "inner").where(predicate)
