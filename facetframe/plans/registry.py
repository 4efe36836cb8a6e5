"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the function under its own name, with the SQL it must agree with, if there is any."""

    def register(run: Run) -> Run:
        name = run.__name__
        if name in RUNS:
            raise ValueError(f"query {name} is registered twice")
        RUNS[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register
