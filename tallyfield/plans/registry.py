"""All registered queries of the library with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import documents, fieldwork, layouts, lists, rebuilds, sheets, state, streams  # noqa: F401  register their queries
from .reports import QUERIES, SQL

FLAGSHIP = "revenue_member_day"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
