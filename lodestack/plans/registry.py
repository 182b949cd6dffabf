"""All registered queries, by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with DuckDB SQL for the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


MODULES = ("intake", "structure", "extraction", "records", "claims", "publishing", "evaluation", "streams", "stores")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"lodestack.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["supersession"](spark, sf_dir)
