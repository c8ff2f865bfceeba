"""All queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import detail_queries, fold_queries, input_queries, model_queries, more_queries, relation_queries  # noqa: F401  register their queries
from tallyloom.plans.queries import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
