"""Registered queries: a name, a Spark callable over a data folder, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def all_queries() -> dict[str, Query]:
    from strandtide.plans import queries_history, queries_relations, queries_scalars, queries_sequences, queries_trees  # noqa: F401

    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    all_queries()
    return dict(_SQL)
