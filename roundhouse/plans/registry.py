"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roundhouse.plans.fixtures import Inputs, duckdb_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers f(inputs) -> DataFrame as a query; sql: its twin over given and derived tables."""

    def register(f: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Inputs(spark, sf_dir))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = duckdb_text(sql)
        return f

    return register
