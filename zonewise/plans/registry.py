"""Where the plans register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a query under ``name``, with the SQL for the same result if there is one."""

    def add(fn: Plan) -> Plan:
        PLANS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
