"""Named queries over the warehouse tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` gives the same rows and columns on the same tables."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(apply_settings(spark), sf_dir)

        prepared.__name__ = name
        prepared.__doc__ = run.__doc__
        QUERIES[name] = prepared
        if sql is not None:
            CHECKS[name] = sql
        return run

    return register
