"""Registry of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import ensure_settings

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(ensure_settings(spark), folder)


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ints: str = "") -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` is the same query for DuckDB, if it has one.

    ``ints`` names columns that are 32-bit in Spark where DuckDB counts in 64 bits.
    """
    if sql and ints:
        casts = ", ".join(f"{c}::INT AS {c}" for c in ints.split())
        sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"

    def register(build: Builder) -> Builder:
        if name in CATALOG:
            raise ValueError(f"query {name!r} registered twice")
        CATALOG[name] = Query(name, build, sql)
        return build

    return register
