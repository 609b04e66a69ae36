"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
plus, where the operator is expressible in SQL, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .oracle.cte import with_ctes


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    body: str | None

    @property
    def sql(self) -> str | None:
        """Oracle statement; CTE prefixes are resolved after every module
        has registered its fragments."""
        return with_ctes(self.body) if self.body else None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn`` under ``name``; ``sql`` is the oracle body
    (CTE prefixes are added automatically)."""
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from . import queries  # noqa: F401  (registers everything)
    return REGISTRY
