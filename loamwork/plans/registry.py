"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under ``name``; ``sql`` is its DuckDB counterpart."""

    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
