"""Reading the test tables, and the register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Register:
    """Queries by name with their SQL: ``@register(sql)`` over a function (read) -> DataFrame, read being name -> table."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def keep(build):
            name = build.__name__
            self.queries[name] = lambda spark, sf_dir: build(lambda t: table(spark, sf_dir, t))
            if sql:
                self.sql[name] = sql
            return build

        return keep
