"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame`` plus,
where the operator is SQL-expressible, the equivalent ANSI SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle SQL text."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return wrap


def load_all() -> None:
    """Import every module that registers queries."""
    from stratum.plans import (  # noqa: F401
        q_relational,
        q_seasons,
        q_profile,
        q_text,
        q_stream,
        q_genotype,
        q_io,
        q_ml,
    )
