"""The queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register the function under its name, with the SQL it must agree with, if there is any."""

    def register(run: Run) -> Run:
        RUNS[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql.strip()
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
