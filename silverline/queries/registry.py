"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.queries.folder import use_local_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES: dict[str, str] = {}


class Tables:
    """The given tables by name: `t.part` reads part.parquet."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of (tables) under a name, with its SQL when there is one."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"Duplicate query {name}")
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_local_folder(spark)
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        MODULES[name] = fn.__module__
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return register


def names_of(*modules) -> list[str]:
    """Queries defined in the given modules."""
    wanted = {m.__name__ for m in modules}
    return [n for n, m in MODULES.items() if m in wanted]
