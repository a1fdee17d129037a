"""All queries of the core, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subloom.plans import interval_queries, reference_queries, reference_sql

QUERIES = [interval_queries.QUERIES, reference_queries.QUERIES]
SQL = [interval_queries.SQL, reference_sql.SQL]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for part in QUERIES for name, q in part.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for part in SQL for name, q in part.items()}
