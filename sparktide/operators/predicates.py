"""Filters and projections, each written so the predicate reaches the scan."""

from __future__ import annotations

import calendar
import datetime as dt
import re
import struct
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.functions import temporal, text
from sparktide.workspace import materialise


def _type_of(df: DataFrame, col: str):
    return df.schema[col].dataType


def select_star_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def project_where(df: DataFrame, cols: Sequence[str], predicate: Column | str) -> DataFrame:
    return df.where(predicate).select(*cols)


# --- column lists and wildcard rows -----------------------------------------


def columns_like(columns: Sequence[str], patterns: str) -> list[str]:
    """Columns in the order of a bracketed pattern list, each at most once.

    ``[a][b%][%]`` is column ``a``, then those starting with ``b``, then the rest.
    """
    chosen: list[str] = []
    for pattern in re.findall(r"\[([^\]]*)\]", patterns):
        rule = re.compile(".*".join(re.escape(p) for p in pattern.split("%")), re.IGNORECASE)
        chosen += [c for c in columns if c not in chosen and rule.fullmatch(c)]
    return chosen


def select_columns_like(df: DataFrame, patterns: str) -> DataFrame:
    return df.select(*columns_like(df.columns, patterns))


# What a wildcard filter can look at, and the column that holds it; fixed names.
FILTER_KINDS = {
    "login": "login_name",
    "session": "session_id",
    "host": "host_name",
    "program": "program_name",
    "database": "database_name",
}


def _kind_like(kind: str, pattern: str, collation: str | None) -> Column:
    return text.like(F.col(FILTER_KINDS[kind]).cast("string"), pattern, collation)


def filter_like(df: DataFrame, kind: str, pattern: str, collation: str | None = None) -> DataFrame:
    return df.where(_kind_like(kind, pattern, collation))


def filter_like_except(
    df: DataFrame, keep: tuple[str, str], drop: tuple[str, str], collation: str | None = None
) -> DataFrame:
    """Rows matching ``keep`` and not ``drop``, both as (kind, pattern)."""
    return df.where(_kind_like(*keep, collation) & ~_kind_like(*drop, collation))


# Sessions up to this id belong to the server itself.
LAST_SYSTEM_SESSION = 50


def include_states(df: DataFrame, sleeping: int = 0, system: bool = False) -> DataFrame:
    """Hide idle and system sessions unless asked for.

    ``sleeping``: 0 hides idle sessions, 1 shows those with an open
    transaction, 2 shows all.
    """
    if sleeping == 0:
        df = df.where(F.col("status") != "sleeping")
    elif sleeping == 1:
        df = df.where((F.col("status") != "sleeping") | (F.col("open_tran_count") > 0))
    if not system:
        df = df.where(F.col("session_id") > LAST_SYSTEM_SESSION)
    return df


# --- typed equality ---------------------------------------------------------


_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _holds(kind: T.DataType, value) -> bool:
    """Whether a column of this type can hold the value as it is."""
    if isinstance(value, (bool, str)) or not isinstance(value, (int, float, Decimal)):
        # A time of day is no date.
        return not (isinstance(kind, T.DateType) and isinstance(value, dt.datetime) and value.time() != dt.time())
    number = Decimal(repr(value)) if isinstance(value, float) else Decimal(value)
    if isinstance(kind, T.IntegralType):
        bound = 2 ** (_INTEGER_BITS[kind.simpleString()] - 1)
        return number.is_finite() and number == number.to_integral_value() and -bound <= number < bound
    if isinstance(kind, T.DecimalType):
        fits = number.is_finite() and abs(number) < Decimal(10) ** (kind.precision - kind.scale)
        return fits and -number.normalize().as_tuple().exponent <= kind.scale
    if isinstance(kind, T.FloatType):
        return not number.is_finite() or (abs(value) <= 3.4028234663852886e38 and Decimal(struct.unpack("f", struct.pack("f", value))[0]) == Decimal(value))
    return True


def _as_column(df: DataFrame, col: str, value) -> tuple[Column, bool]:
    """The value in the column's type, and whether it keeps its meaning there.

    A fraction is no integer, 3.701 no decimal with two places, 40000 no smallint, a time
    of day no date: such a value equals no value of the column, and is no error.
    """
    kind = _type_of(df, col)
    if not _holds(kind, value):
        return F.lit(None).cast(kind), False
    return F.lit(value).cast(kind), True


def filter_equal_typed(df: DataFrame, col: str, value) -> DataFrame:
    """Equality with the value converted to the column's type, never the reverse."""
    return df.where(F.col(col) == _as_column(df, col, value)[0])


def filter_joined_literal(df: DataFrame, col: str, *parts: str) -> DataFrame:
    """``col = part + part …``: the literals fold to one."""
    return df.where(F.col(col) == F.concat(*[F.lit(p) for p in parts]))


def filter_suffixed_equals(df: DataFrame, col: str, suffix: str, value: str) -> DataFrame:
    """``col + suffix = value`` with the column alone on one side."""
    if not value.endswith(suffix):
        return df.where(F.lit(False))
    return df.where(F.col(col) == value[: len(value) - len(suffix)])


# --- dates ------------------------------------------------------------------


def _count(df: DataFrame, key: str | None) -> DataFrame:
    """Rows with a non-null ``key``, or all rows."""
    return df.agg(F.count(key or "*").alias("n"))


def count_year_function(df: DataFrame, col: str, year: int, key: str | None = None) -> DataFrame:
    """Right answer, but the function hides the column from the scan."""
    return _count(df.where(F.year(col) == year), key)


def count_year_between(df: DataFrame, col: str, year: int, key: str | None = None) -> DataFrame:
    """Closed range up to midnight of 31 December: later rows of that day are lost."""
    lo, hi = dt.datetime(year, 1, 1), dt.datetime(year, 12, 31)
    return _count(filter_time_between(df, col, lo, hi), key)


def count_year_half_open(df: DataFrame, col: str, year: int, key: str | None = None) -> DataFrame:
    return _count(filter_year(df, col, year), key)


def filter_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """All rows of a calendar year; both bounds are pushed to the scan."""
    lo, hi = temporal.year_start(year), temporal.year_start(year + 1)
    return df.where((F.col(col) >= _time(df, col, lo)) & (F.col(col) < _time(df, col, hi)))


def count_day_as_text(df: DataFrame, col: str, day: dt.date, key: str | None = None) -> DataFrame:
    """Rows of one day, whatever their time; the optimizer turns it into a range."""
    return _count(df.where(F.to_date(col) == F.lit(day)), key)


def count_shifted_date_equals(
    df: DataFrame, col: str, as_of: dt.datetime, key: str | None = None, years: int = 1
) -> DataFrame:
    """Rows whose time, moved back by ``years``, is ``as_of``.

    The shift is moved to the constant so that the column stays bare. Moved
    back to a common year 29 February becomes the 28th, so it counts as well.
    """
    target = _time(df, col, as_of) + F.make_interval(years=F.lit(years))
    same = F.col(col) == target
    if (as_of.month, as_of.day) == (2, 28) and not calendar.isleap(as_of.year):
        leap_day = F.col(col) == target + F.make_interval(days=F.lit(1))
        same |= leap_day & (F.month(col) == 2)
    elif (as_of.month, as_of.day) == (2, 29):
        # Only a shift between leap years ever lands on 29 February.
        same &= F.dayofmonth(col) == 29
    return _count(df.where(same), key)


def count_arith_predicate(df: DataFrame, col: str, amount: float, key: str | None = None) -> DataFrame:
    """``col - amount > 0`` with the arithmetic moved to the constant."""
    return _count(df.where(F.col(col) > amount), key)


def _time(df: DataFrame, col: str, value) -> Column:
    return F.lit(value).cast(_type_of(df, col))


def filter_time_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed window; prunes partitions when ``col`` is one.

    On a date column the first date is the first that isn't before ``lo``.
    """
    if isinstance(_type_of(df, col), T.DateType) and isinstance(lo, dt.datetime) and lo.time() != dt.time():
        lo = lo.date() + dt.timedelta(days=1)
    return df.where(F.col(col).between(_time(df, col, lo), _time(df, col, hi)))


# --- nulls ------------------------------------------------------------------


def filter_null_sentinel(df: DataFrame, col: str, value, sentinel) -> DataFrame:
    """Null stands for ``sentinel`` on both sides, so a real sentinel matches too."""
    kind = _type_of(df, col)
    stand_in = F.lit(sentinel).cast(kind)
    wanted, exact = _as_column(df, col, value)
    if not exact:
        return df.where(F.lit(False))
    return df.where(F.coalesce(F.col(col), stand_in) == F.coalesce(wanted, stand_in))


def filter_null_or(df: DataFrame, col: str, value) -> DataFrame:
    wanted, exact = _as_column(df, col, value)
    if not exact:
        return df.where(F.lit(False))
    return df.where((F.col(col) == wanted) | (F.col(col).isNull() & wanted.isNull()))


def filter_null_safe(df: DataFrame, col: str, value) -> DataFrame:
    """Equality in which null equals null; pushed to the scan as such."""
    wanted, exact = _as_column(df, col, value)
    return df.where(F.col(col).eqNullSafe(wanted) if exact else F.lit(False))


def filter_optional(df: DataFrame, col: str, value) -> DataFrame:
    """No value, no filter."""
    return df if value is None else filter_equal_typed(df, col, value)


# --- lists ------------------------------------------------------------------


def filter_in_table(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """Rows whose ``col`` is in a one-column table (runs a job).

    The distinct values are written first: their exact size decides whether
    they are broadcast, and otherwise AQE can split a value of very many rows.
    """
    wanted = materialise(values.select(F.col(values.columns[0]).alias(col)).distinct(), "wanted")
    return df.join(wanted, col, "left_semi")


def _in_list(df: DataFrame, col: str, values: list) -> DataFrame:
    """A list of any length is a set in the plan; values in a table go to ``filter_in_table``."""
    return df.where(F.col(col).isin(values))


def filter_in_numbers(df: DataFrame, col: str, values: Iterable[int]) -> DataFrame:
    return _in_list(df, col, list(values))


def filter_in_text_vs_numbers(
    df: DataFrame, col: str, values: Iterable[int], numeric: bool = False
) -> DataFrame:
    """Numbers looked up in a text column.

    By default the numbers become text, which keeps the column bare. With
    ``numeric`` the meaning of a converted column is kept ('01' equals 1) and
    text that is no number matches nothing instead of failing the query.
    """
    values = list(values)
    if not numeric:
        return _in_list(df, col, [str(v) for v in values])
    return df.where(F.col(col).try_cast("bigint").isin(values))


def filter_in_text(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    return _in_list(df, col, list(values))


def filter_or_chain(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``col = a OR col = b OR …`` folded into one IN, typed like the column."""
    values = list(values)
    if _type_of(df, col).typeName() == "string":
        values = [str(v) for v in values]
    return _in_list(df, col, values)


def filter_not_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows with a null column drop out, as three-valued logic has it."""
    return df.where(~F.col(col).isin(list(values)))


# --- other shapes -----------------------------------------------------------


def filter_like_contains(
    df: DataFrame, col: str, fragment: str, collation: str | None = None
) -> DataFrame:
    return df.where(F.contains(text.collated(F.col(col), collation), F.lit(fragment)))


def filter_two_columns(df: DataFrame, a: str, b: str, total) -> DataFrame:
    return df.where(F.col(a) + F.col(b) == total)


def filter_column_plus_value(df: DataFrame, a: str, value, total) -> DataFrame:
    return df.where(F.col(a) == total - value)


def filter_case_equals(
    df: DataFrame, col: str, cases: Sequence[tuple[Column, object]], default=None
) -> DataFrame:
    """``col = CASE WHEN … THEN … END``; without a match nothing is equal."""
    wanted = F.lit(default)
    for condition, value in reversed(cases):
        wanted = F.when(condition, F.lit(value)).otherwise(wanted)
    return df.where(F.col(col) == wanted)


def filter_modulo(df: DataFrame, col: str, modulus: int, remainder: int = 0) -> DataFrame:
    return df.where(F.col(col) % modulus == remainder)


def filter_binary_equals(df: DataFrame, col: str, value: bytes) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def config_value(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("name").isin(list(names)))


def parameterised(spark: SparkSession, sql: str, args: dict, **frames: DataFrame) -> DataFrame:
    """A saved query with named parameters; frames are named in braces."""
    return spark.sql(sql, args=args, **frames)
