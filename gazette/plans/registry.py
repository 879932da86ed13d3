"""The query registry shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    """Import every catalog module, then return the registry."""
    from gazette.plans import catalog, catalog_db, catalog_formats, catalog_runs  # noqa: F401

    return dict(REGISTRY)
