"""Registers queries with the SQL of the same rows."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from geolith.session import importable


class Registry:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        """A decorator: the query goes under its function's name; without sql, tests check its rows."""

        def add(f):
            @functools.wraps(f)
            def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
                importable(spark)
                return f(spark, sf_dir)

            self.queries[f.__name__] = ready
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add
