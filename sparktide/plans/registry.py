"""The registry: a name, the survey rows it covers, the Spark query, the checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparktide.plans.views import Tables, with_views


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None, views: str = "", recursive: bool = False):
    """Register the decorated builder; ``views`` are put in front of the SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        text = None if sql is None else with_views(tuple(views.split()), sql, recursive)
        REGISTRY[name] = Query(name, tuple(covers.split()), build, text)
        return build

    return register
