"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word is a run of anything but blank, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"

LEAST = -(2**63)

#: Rows of an Arrow batch that a Python function sees at once, so that what it makes of them stays small.
SLICE_ROWS = 512


def text_of(column: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_in(column: str | Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def ordered(column: str | Column) -> Column:
    """A long id with null in front of all others, so that maxima and joins see null rows."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(LEAST))


def unordered(column: str | Column) -> Column:
    """The id of ``ordered``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != LEAST, column)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under names that no column of an operator has, and the new name of each of its columns."""
    names = {c: f"given{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def brought_back(names: dict[str, str]) -> list[Column]:
    """The columns of ``set_aside`` under their own names."""
    return [F.col(new).alias(c) for c, new in names.items()]


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: T.StructType) -> DataFrame:
    """Arrow batches through a function that ``make`` builds once per task.

    The function gives a list or array per column of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                made = step(batch.slice(at, SLICE_ROWS))
                arrays = [
                    made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], f.type)
                    for n, f in zip(names, arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def parts_for(rows: int, each: int) -> int:
    """Number of parts so that none is expected to hold more than ``each`` rows."""
    return max(1, -(-rows // each))
