"""Registry of named queries, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when asked for: tables.orders."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register f(tables) -> DataFrame under a name."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, path: f(Tables(spark, path))
        if sql:
            ORACLE[name] = sql
        return f

    return add
