"""The query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with its SQL."""

    def add(run: Run) -> Run:
        name = run.__name__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
