"""Query registry: key -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Query modules decorate their functions with `@query(key, oracle=..., views=...)`;
`oracle` is DuckDB SQL over the driver tables, `views` lists the derived views
it needs as CTEs. Keys without an oracle get the driver's rows-only check.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    def register(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_views(oracle, *views) if views else oracle.strip()
        return fn

    return register


def _load_all() -> None:
    # Import for the registration side effect.
    from silverline.plans import (  # noqa: F401
        q_analytics, q_quality, q_io, q_versions, q_streaming, q_udfs,
    )


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
