"""The register that query modules fill: name, DataFrame and, where SQL can tell it, SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


class Register:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        """Registers a function of a table reader under a name, with its SQL."""

        def add(function: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(lambda t: table(spark, sf_dir, t))

            query.__name__, query.__doc__ = name, function.__doc__
            self.queries[name] = query
            if sql:
                self.oracles[name] = sql
            return query

        return add
