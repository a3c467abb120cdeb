"""Registered queries, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return run

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and twins; importing the modules registers them."""
    from driftwise.plans import (  # noqa: F401
        evaluation_queries,
        fusion_queries,
        model_queries,
        prep_queries,
        profile_queries,
        resample_queries,
    )

    return dict(QUERIES), dict(TWINS)
