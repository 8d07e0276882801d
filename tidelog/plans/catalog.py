"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql`` answers the same question in the checking engine."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> None:
    """Import every module that registers queries."""
    from tidelog.plans import defaults, delivery, logs, messages, retention, schemas, streams  # noqa: F401
    from tidelog.plans import guarantees, nested, scales  # noqa: F401  # some of their twins are those of the others
