"""Named queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

CATALOGS = ("basics", "quality", "describe", "correlate", "reduce", "resample", "metrics", "train", "scores")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries named {name}")
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def _load() -> None:
    for catalog in CATALOGS:
        importlib.import_module(f"rowsmith.plans.catalog_{catalog}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
