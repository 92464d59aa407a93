"""Named queries over the driver's tables, each with the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (read -> DataFrame) under its own name; ``read`` gives a table by its name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            SQL[f.__name__] = dedent(sql).strip()
        return f

    return add
