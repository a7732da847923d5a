"""The registered queries: one module per family, each with its Spark side and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stagehouse.plans import layouts, relational, scans, sinks

_FAMILIES = (scans, sinks, layouts, relational)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: run for family in _FAMILIES for key, run in family.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {key: text for family in _FAMILIES for key, text in family.SQL.items()}
