"""Registry of named queries over the test tables and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``; its oracle (when the
semantics fit in SQL) is a DuckDB SQL string over the same tables, with the
same column names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register themselves."""
    from shelfmatch.plans import (catalog_queries, corpus, metric_queries, pipeline_queries,  # noqa: F401
                                  table_queries, text_queries)
