"""Named query registry: each entry pairs a Spark plan with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. ``sql`` is ANSI-ish SQL that
DuckDB runs on views named after the driver's tables; ``None`` marks an
operator with no SQL form (checked on row counts plus unit tests instead).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, ops: tuple[str, ...] = ()):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def registry() -> dict[str, Query]:
    # Importing the catalog modules fills the registry.
    from vigil.plans import catalog, q_classify, q_correlate, q_curation, q_text, q_verify  # noqa: F401
    return dict(_REGISTRY)
