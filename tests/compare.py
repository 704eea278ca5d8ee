"""Compare a Spark result with the DuckDB result of its checking SQL."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs in names, types, row count and values; empty when all agree."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    found = []
    if sorted(relation.columns) != names:
        return [f"columns {sorted(relation.columns)} against {names}"]
    duck_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for field in df.schema:
        expected = SPARK_TO_DUCK.get(field.dataType.simpleString(), field.dataType.simpleString())
        if duck_types[field.name] != expected:
            found.append(f"type of {field.name}: {duck_types[field.name]} against {expected}")
    quoted = ", ".join(f'"{n}"' for n in names)
    expected_rows = Counter(con.execute(f"SELECT {quoted} FROM ({sql}) AS q").fetchall())
    rows = Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())
    if expected_rows != rows:
        missing, extra = expected_rows - rows, rows - expected_rows
        found.append(
            f"{sum(rows.values())} rows against {sum(expected_rows.values())}; "
            f"missing {list(missing)[:2]}, extra {list(extra)[:2]}"
        )
    return found
