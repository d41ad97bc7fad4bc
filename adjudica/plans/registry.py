"""The list of queries: what Spark runs, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """One query, with its check where SQL can express it."""

    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register the decorated function under ``name``."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    """Every registered query."""
    from adjudica.plans import (  # noqa: F401
        queries_ask,
        queries_entities,
        queries_queue,
        queries_run,
        queries_scalars,
        queries_sources,
        queries_text,
        queries_versions,
    )

    return QUERIES
