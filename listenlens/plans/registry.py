"""Registry of named queries: a Spark builder and, where SQL can say it, an oracle.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables; the oracle is DuckDB SQL over the same tables (views named like
the parquet files).  Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Builder
    sql: str | None
    survey_ids: str


_QUERIES: dict[str, NamedQuery] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def wrap(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = NamedQuery(name, fn, sql, ids)
        return fn
    return wrap


def all_queries() -> dict[str, NamedQuery]:
    # importing the modules fills the registry
    from listenlens.plans import (  # noqa: F401
        charts, classify, content, factors, interactions, recommend, themes, vectors,
    )
    return dict(_QUERIES)
