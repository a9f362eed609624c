"""All queries of the core and the SQL they are checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "clean_pipeline_metrics"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL of the same result where SQL can say it."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"two queries named {name}")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


MODULES = ("cleaning", "profiling", "panels", "drifting", "evaluating", "opinions", "streams", "files", "checking", "merging", "runs", "reports")


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
