"""Type conversion, null handling and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_of_width(col: Column, width: int) -> Column:
    """An integer as text, or ``*`` when it has more characters than ``width``."""
    text = col.cast("string")
    return F.when(F.length(text) > width, F.lit("*")).otherwise(text)


def null_to(col: Column, default: Column) -> Column:
    return F.coalesce(col, default)


def whole_division(a: Column, b: Column) -> Column:
    """Integer division that truncates towards zero; raises on a zero divisor."""
    return F.call_function("div", a, b)


def rounded_mean(total: Column, n: Column) -> Column:
    """Mean of a non-negative integer sum, rounded half up to an integer; exact beyond the range of bigint."""
    total, n = total.cast("decimal(36,0)"), n.cast("decimal(19,0)")
    return whole_division(total * 2 + n, n * 2)


def wide_sum(column: str) -> Column:
    """The sum of integers, as a decimal that doesn't overflow."""
    return F.sum(F.col(column).cast("decimal(20,0)"))


def divide_or_null(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def bytes_of(value: int) -> Column:
    """The one-byte binary literal for ``value``."""
    return F.lit(bytes([value]))


def first_match(col: Column, labels: dict, default: str) -> Column:
    """``CASE col WHEN k THEN label …``: the first equal key wins."""
    out = None
    for key, label in labels.items():
        out = F.when(col == key, label) if out is None else out.when(col == key, label)
    return out.otherwise(default)
