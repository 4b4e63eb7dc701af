"""SQL over registered tables, and tables of an external database."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, Any] | list[Any] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The result of a SQL query.

    ``args`` fills ``:name`` or ``?`` markers. ``views`` are registered under
    their names first and replace temporary views of the same name.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args) if args else spark.sql(text)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A query on, or a table of, an external database.

    With a partition column, its bounds and a count, as many connections read
    in parallel; the bounds split the range and exclude no row. Otherwise one
    task reads everything, which suits small results only.
    """
    return (
        spark.read.format("jdbc")
        .options(
            **jdbc_options(
                url,
                query,
                dbtable,
                partition_column,
                bounds,
                partitions,
                properties,
            )
        )
        .load()
    )


def jdbc_options(
    url: str,
    query: str | None = None,
    dbtable: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of ``read_jdbc``."""
    if (query is None) == (dbtable is None):
        raise ValueError("give either query or dbtable")
    options = {"url": url, **(properties or {})}
    if partition_column is None:
        options["query" if query else "dbtable"] = query or dbtable
        return options
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and partitions")
    # The reader takes no partition column along with "query".
    options["dbtable"] = dbtable or f"({query}) AS source_query"
    options["partitionColumn"] = partition_column
    options["lowerBound"], options["upperBound"] = map(str, bounds)
    options["numPartitions"] = str(partitions)
    return options
