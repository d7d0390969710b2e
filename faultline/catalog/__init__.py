"""The registered queries: each pairs a Spark job on the given tables with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_MODULES = ("assets", "cleaning", "features", "profiling", "ranking", "risks", "survivals", "scoring", "selection",
            "segments", "learning", "storage")


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    for m in _MODULES:
        import_module(f"faultline.catalog.{m}")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
