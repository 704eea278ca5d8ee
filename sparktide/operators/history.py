"""Analysis of exported query history: queries, texts, plans, run statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktide.functions import text
from sparktide.operators import predicates
from sparktide.workspace import materialise

# Execution outcome recorded with run statistics; fixed values of the export.
EXECUTION_FAILED = 4


def _with_text(queries: DataFrame, texts: DataFrame) -> DataFrame:
    return queries.join(texts, "query_text_id", "inner").select("query_id", "query_sql_text")


def query_by_object(queries: DataFrame, texts: DataFrame, object_id: int) -> DataFrame:
    return _with_text(queries.where(F.col("object_id") == object_id), texts)


def query_by_text(queries: DataFrame, texts: DataFrame, pattern: str) -> DataFrame:
    return _with_text(queries, texts.where(text.like(F.col("query_sql_text"), pattern)))


def query_by_time(queries: DataFrame, texts: DataFrame, lo, hi) -> DataFrame:
    return _with_text(predicates.filter_time_between(queries, "last_execution_time", lo, hi), texts)


def failed_forced_plans(plans: DataFrame, queries: DataFrame) -> DataFrame:
    """Forced plans the server could not use, with the object they belong to."""
    failed = plans.where((F.col("is_forced_plan") == 1) & (F.col("force_failure_count") > 0))
    asked = failed.select("query_id").distinct()
    owner = queries.select("query_id", F.col("object_id").alias("containing_object_id")).join(asked, "query_id", "left_semi")
    # Written, so that AQE can split the plans of a query that has very many.
    owner = materialise(owner, "plan_owners")
    return failed.join(owner, "query_id", "inner").select(
        "query_id",
        "plan_id",
        "containing_object_id",
        "force_failure_count",
        "last_force_failure_reason",
        "last_force_failure_reason_desc",
        "last_execution_time",
    )


def parsed_plan(col: Column) -> Column:
    """A whole plan document as a VARIANT, to be asked with ``plan_value``; null for text that is no XML.

    Any well-formed document survives, whatever its elements: attributes are fields with
    ``_`` in front, repeated elements are arrays.
    """

    def parsed(text: Column) -> Column:
        # The parser of variants fails on broken text, so a parser that reports it looks first.
        looked = F.from_xml(text, "none STRING, broken STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
        return F.when(F.contains(text, F.lit("<")) & looked["broken"].isNull(), F.from_xml(text, "variant"))

    # Within a lambda it is evaluated without generated code, which has the wrong type for a variant (4.1).
    return F.get(F.transform(F.array(col), parsed), F.lit(0))


def plan_value(plan: Column | str, path: str, kind: str) -> Column:
    """What a parsed plan holds at a path such as ``$.op.name``; null where it holds nothing of the kind."""
    return F.try_variant_get(plan, path, kind)


def aborted_executions(
    queries: DataFrame, plans: DataFrame, texts: DataFrame, stats: DataFrame, as_of: dt.datetime, days: int = 1
) -> DataFrame:
    """Failed runs of queries last executed within ``days`` of ``as_of``, with the plan as text and parsed.

    All filters sit below the joins: plans are cut to those with failed runs, then to recent
    queries, and what is left is parsed before its runs multiply it. A plan that is no XML
    keeps its row, with a null ``plan``.
    """
    kind = queries.schema["last_execution_time"].dataType
    since = F.lit(as_of - dt.timedelta(days=days)).cast(kind)
    recent = queries.where(F.col("last_execution_time") > since).select("query_id", "query_text_id")
    # Written, so that AQE can split the plans of a query that has very many.
    recent = materialise(recent, "recent_queries")
    failed = stats.where(F.col("execution_type") == EXECUTION_FAILED)
    with_plan = (
        plans.select("query_id", "plan_id", "query_plan")
        .join(failed.select("plan_id").distinct(), "plan_id", "left_semi")
        .join(recent, "query_id", "inner")
        .join(texts, "query_text_id", "inner")
        .select("query_id", "plan_id", "query_sql_text", "query_plan", parsed_plan(F.col("query_plan")).alias("plan"))
    )
    return with_plan.join(failed, "plan_id", "inner").select(
        "query_id",
        "query_sql_text",
        "execution_type",
        "execution_type_desc",
        "query_plan",
        "plan",
        "count_executions",
        "last_execution_time",
    )


def plan_for_handle(cache: DataFrame, plans: DataFrame, handle: int) -> DataFrame:
    """The cached entry of one plan handle with its plan; the handle filters both sides."""
    wanted = F.col("plan_id") == handle
    return cache.where(wanted).join(
        plans.where(wanted).select("plan_id", "query_plan"), "plan_id", "inner"
    )


def history_status(options: DataFrame) -> DataFrame:
    """State of each database's history store, with the space left in it."""
    return options.select(
        "database_name",
        "actual_state_desc",
        "readonly_reason",
        "max_storage_size_mb",
        (F.col("max_storage_size_mb") - F.col("current_storage_size_mb")).alias(
            "query_store_free_space_mb"
        ),
        "flush_interval_seconds",
        "interval_length_minutes",
        "stale_query_threshold_days",
        "max_plans_per_query",
        "query_capture_mode_desc",
        "size_based_cleanup_mode_desc",
    )


def expire_history(queries: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """History that is kept when older queries are dropped."""
    kind = queries.schema["last_execution_time"].dataType
    limit = F.lit(as_of - dt.timedelta(days=days)).cast(kind)
    return queries.where(F.col("last_execution_time") >= limit)


def unforce_plans(plans: DataFrame, query_id: int, plan_id: int) -> DataFrame:
    """The plan table with one plan no longer forced."""
    target = (F.col("query_id") == query_id) & (F.col("plan_id") == plan_id)
    return plans.withColumn("is_forced_plan", F.when(target, 0).otherwise(F.col("is_forced_plan")))
