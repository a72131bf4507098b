"""Registry of named queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("axis", "values", "checks", "tables", "reports", "meters", "kpis", "stores")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the equivalent SQL if there is one."""

    def register(fn: Query) -> Query:
        if fn.__name__ in _QUERIES:
            raise ValueError(f"duplicate query {fn.__name__}")
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return register


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"gridloom.catalog.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
