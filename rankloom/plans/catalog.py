"""The catalogue of registered queries: a Spark plan and, where SQL can express it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under a name, with its checking SQL if there is one."""

    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return add
