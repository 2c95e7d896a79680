"""Named-query catalog: key -> (spark callable, DuckDB oracle SQL or None).

Each query module registers its keys with :func:`query`.  A callable takes
``(spark, sf_dir)`` and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


def load_all() -> None:
    # Importing registers the queries.
    from adlake.plans import (  # noqa: F401
        q_decisions,
        q_features,
        q_models,
        q_quality,
        q_reports,
        q_resolve,
        q_stream,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
