"""Registry of the queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with equivalent SQL over the same tables where there is any."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def load() -> dict[str, Query]:
    """All core queries; importing their modules registers them."""
    from importlib import import_module
    from pkgutil import iter_modules

    from corpusloom import plans

    for module in iter_modules(plans.__path__):
        import_module(f"{plans.__name__}.{module.name}")
    return QUERIES
