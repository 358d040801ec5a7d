"""Registry of the runnable queries and the SQL that states what each must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; `sql` is left out where SQL cannot state the result."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def half_up(expression: str, digits: int = 2) -> str:
    """SQL for rounding the shortest decimal form of a double half away from zero, as Spark does."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
