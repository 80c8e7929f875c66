"""Registration of queries on the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, read by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, covers: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``covers`` lists the operator ids it runs."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        COVERS[name] = covers
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register
