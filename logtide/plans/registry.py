"""Registry of queries: name, Spark plan, and the DuckDB text that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from logtide.plans.oracle import with_views

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, plan, with_views(sql, *views) if sql else None)
        return plan
    return register
