"""All queries of the subpackage, and SQL where SQL can express them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ["queries_text", "queries_splits", "queries_dedupe", "queries_tokens"]


def _each(attribute: str) -> dict:
    return {name: x for m in MODULES for name, x in getattr(importlib.import_module(f"subloom.llm.{m}"), attribute).items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _each("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _each("SQL")
