"""Query registry: ``queries()`` (Spark) and ``oracle_sql()`` (DuckDB SQL).

Each registered query reads the driver tables (or views Spark derives from
them) in full. Operator modules register through :func:`register`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalis.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, views: list[str] | None = None, sql: str | None = None):
    """Decorator: register a Spark query and (optionally) its oracle SQL,
    which may reference derived views by name (inlined as CTEs)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_views(views or [], sql)
        return fn

    return deco


def _load_all() -> None:
    # Importing the catalog modules fills the registry.
    from vitalis.plans import catalog  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
