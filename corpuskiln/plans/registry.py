"""One table of named queries: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuskiln.session import ship

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries and the SQL that checks them."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")

            @functools.wraps(fn)
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                ship(spark)
                return fn(spark, sf_dir)

            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, in the splits it is stored in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
