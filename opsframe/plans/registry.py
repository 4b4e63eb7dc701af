"""Registered queries: a Spark plan and, where SQL can say it, the same result
as SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from opsframe.session import configure

Plan = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Plan
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register the decorated plan under ``name``."""

    def register(plan: Plan) -> Plan:
        if name in REGISTERED:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(configure(spark), sf_dir)

        REGISTERED[name] = Query(run, sql)
        return plan

    return register


def table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    columns: list[str] | None = None,
) -> DataFrame:
    """A table, or its named columns."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df if columns is None else df.select(*columns)
