"""Registry of queries: one Spark function and (when SQL can express it) one
equivalent DuckDB query per operator key.

Each query reads the whole test tables of ``sf_dir`` (or data Spark derives
from them) and aliases every computed column to the name used in its SQL.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "sources", "frame", "joins", "aggregates", "ordered", "reshape",
    "timeseries", "udf", "corpus", "features", "stats", "learners", "neighbors",
)


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn

    return deco


def _load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"colonnade.catalog.q_{m}")
        except ModuleNotFoundError as e:
            if e.name != f"colonnade.catalog.q_{m}":
                raise


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
