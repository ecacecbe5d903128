"""Collects the queries and oracles of all check modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

AREAS = ("loans", "scores", "features", "models")

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its oracle."""

    def add(fn: Query) -> Query:
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql
        return fn

    return add


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"checks.{area}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
