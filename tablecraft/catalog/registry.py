"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablecraft.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Tables of one data folder as attributes: ``t.orders``, ``t.nation`` ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


def query(sql: str | None = None, name: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise KeyError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLE[key] = sql
        return build
    return add
