"""All queries of the library by name, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, and the SQL for its rows."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _oracles[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from tidewatch import plans  # noqa: F401  registers what it holds


def queries() -> dict[str, Query]:
    _load()
    return _queries


def oracle_sql() -> dict[str, str]:
    _load()
    return _oracles


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return next(iter(_queries.values()))(spark, sf_dir)
