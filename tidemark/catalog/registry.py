"""Registry of checked queries: a DataFrame function over the given tables, with equal SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one directory, read when asked for: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register ``function(tables)`` under its name."""

    def register(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
