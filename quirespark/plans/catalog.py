"""Registry of the queries on the driver's tables and of their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import layout_queries, text_queries, translation_queries

_PARTS = (text_queries, layout_queries, translation_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the core by name."""
    return {k: q for part in _PARTS for k, (q, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {k: s for part in _PARTS for k, (_, s) in part.QUERIES.items() if s}
