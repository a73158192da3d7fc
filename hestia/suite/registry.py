"""A tiny registry: query name → (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hestia.sources.tables import with_v

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, v: bool = False):
    """Register a Spark query; ``sql`` is its DuckDB oracle (``v=True``
    prefixes the listing view ``V`` as a CTE)."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_v(sql) if v else sql
        return fn

    return deco
