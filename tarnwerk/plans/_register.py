"""A register of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnwerk.sources.ship import ship
from tarnwerk.sources.tables import table


class Register:
    """Queries by name; a query is called with a loader of tables."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def wrap(f):
            key = name or f.__name__

            def run(spark: SparkSession, directory: str) -> DataFrame:
                ship(spark)
                return f(lambda t: table(spark, directory, t))

            run.__name__, run.__doc__ = key, f.__doc__
            self.queries[key] = run
            if sql:
                self.sql[key] = sql
            return f

        return wrap
