"""Name → Spark job and name → oracle SQL.

Modules register their queries with ``@query(name, oracle=SQL)``.  A query
callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the oracle is
an independent DuckDB SQL text over the same base tables (or ``None`` when
the operator is not expressible in SQL and only a rows check applies).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ctes import with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
_RAW_ORACLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def query(name: str, oracle: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            _RAW_ORACLES[name] = (oracle, tuple(ctes))
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import catalog  # noqa: F401


def oracles() -> dict[str, str]:
    """Oracle SQL texts with their CTE closures (resolved after every module
    has defined its CTEs)."""
    load_all()
    return {n: with_ctes(sql, *ctes) for n, (sql, ctes) in _RAW_ORACLES.items()}
