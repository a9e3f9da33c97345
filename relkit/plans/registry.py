"""Registry of named queries and their independent SQL oracles.

A query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators over the base tables.  Its oracle is plain ANSI SQL over
the same tables (run by DuckDB in the verification harness), written
separately so that a wrong operator cannot also produce a matching oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
FAMILIES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, family: str = ""):
    """Register ``fn`` under ``name``; ``oracle=None`` means rows-only check."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        FAMILIES[name] = family or fn.__module__.rsplit(".", 1)[-1]
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco
