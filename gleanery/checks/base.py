"""Registration helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    """Collects one module's queries and their SQL."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            name = query.__name__
            self.queries[name] = query
            if sql is not None:
                self.oracles[name] = sql
            return query

        return register
