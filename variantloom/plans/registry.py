"""Named queries over the given tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from variantloom.plans.bridge import Inputs, standalone_sql


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str | None
    views: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, *views: str):
    def add(run: Callable[[Inputs], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql, views)
        return run

    return add


def _load() -> None:
    from variantloom.plans import (  # noqa: F401
        queries_annotations, queries_calls, queries_clinical, queries_extract, queries_cohort, queries_merge, queries_state,
    )


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(q: Query):
        return lambda spark, directory: q.run(Inputs(spark, directory))

    return {name: bind(q) for name, q in REGISTRY.items()}


def oracles() -> dict[str, str]:
    _load()
    return {name: standalone_sql(q.sql, *q.views) for name, q in REGISTRY.items() if q.sql is not None}
