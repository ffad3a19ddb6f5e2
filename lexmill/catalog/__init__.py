"""Queries over the driver tables, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if given, the SQL that must return the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def load() -> None:
    from lexmill.catalog import (  # noqa: F401
        audit_queries,
        chunk_queries,
        io_queries,
        job_queries,
        merge_queries,
        registry_queries,
        stream_queries,
        text_queries,
        word_queries,
    )
