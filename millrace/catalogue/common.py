"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Registry:
    """Collects queries under their names, with the SQL text next to each."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(fn):
            self.queries[fn.__name__] = fn
            if sql:
                self.sql[fn.__name__] = sql.strip()
            return fn

        return register
