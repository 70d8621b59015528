"""Name -> query and SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitwall.plans.adapters import Tables, with_views

Query = Callable[[Tables], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is equivalent SQL over the adapter views."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if oracle is not None:
            _ORACLES[name] = oracle
        return function

    return register


def _load() -> None:
    from pitwall.plans import (  # noqa: F401
        query_expressions,
        query_gold,
        query_laps,
        query_order,
        query_quality,
        query_sources,
        query_streams,
        query_timing,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query as ``(spark, folder) -> DataFrame``."""
    _load()

    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Tables(spark, folder))

    return {name: bind(function) for name, function in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Complete SQL twins, each with the views it needs."""
    _load()
    return {name: with_views(sql) for name, sql in _ORACLES.items()}
