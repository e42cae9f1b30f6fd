"""Registry of queries: name -> (Spark function, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomwright.session import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        ship_package(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name``, with its SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return add
