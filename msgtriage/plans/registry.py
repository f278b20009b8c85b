"""Query registry: a name, a Spark plan and (optionally) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    ops: tuple[str, ...]
    sql: str | None = None
    tags: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: tuple[str, ...], sql: str | None = None, tags=()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, ops, sql, tuple(tags))
        return fn

    return deco


def r6(c):
    """Round a double column to 6 places (the oracle compare rule)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
