"""Date and time columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def _seconds(col: Column) -> Column:
    """Whole seconds since 1970 on the clock the timestamp shows, whatever the session zone."""
    of_day = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    return F.unix_date(F.to_date(col)).cast("bigint") * 86_400 + of_day


def _millis(col: Column) -> Column:
    within = F.floor((F.date_part(F.lit("SECOND"), col) - F.second(col)) * 1000)
    return _seconds(col) * 1000 + within.cast("bigint")


_TICKS = {"second": _seconds, "millisecond": _millis}


def micros_between(start: Column, end: Column) -> Column:
    """Elapsed microseconds."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def year_of(col: Column) -> Column:
    return F.year(col)


def shift_years(col: Column, years: int) -> Column:
    """Move a timestamp by whole years, keeping its time of day."""
    return col + F.make_interval(years=F.lit(years))


def boundaries_between(unit: str, start: Column, end: Column) -> Column:
    """How many unit boundaries lie between two timestamps.

    0.9 s to 1.1 s crosses one second boundary, so the answer is 1 although
    less than a second has passed.
    """
    ticks = _TICKS[unit]
    return ticks(end) - ticks(start)


def year_start(year: int) -> dt.datetime:
    return dt.datetime(year, 1, 1)
