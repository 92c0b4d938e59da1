"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import full_queries, more_queries, rail_queries, serve_queries  # noqa: F401  the others add their queries to those of rail_queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rail_queries.QUERIES["stats_operators"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(rail_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(rail_queries.SQL)
