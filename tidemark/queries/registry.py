"""Name -> query, name -> SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """``t.orders`` reads orders.parquet of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def load_all() -> None:
    from tidemark.queries import (  # noqa: F401
        aggregates,
        calendars,
        capture,
        filters,
        lookups,
        lots,
        ordered,
        projects,
        quality,
        reshaping,
        sales,
        scalars,
        scans,
    )
