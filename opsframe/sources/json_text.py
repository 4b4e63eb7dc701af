"""JSON sources: tolerant lines and whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import is_json
from opsframe.session import configure


def parse_lines(
    lines: DataFrame,
    schema: T.StructType | str | None = None,
    column: str = "value",
) -> DataFrame:
    """Drop the lines that are no JSON and read the others with ``schema``.

    Scalars and ``null`` are JSON: they stay as rows, all NULL under a schema.
    Without a schema the valid lines come back as text.
    """
    valid = lines.filter(is_json(column))
    if schema is None:
        return valid
    parsed = valid.withColumn("_record", F.from_json(column, schema))
    others = [c for c in lines.columns if c != column]
    return parsed.select(*others, "_record.*")


def read_json_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read JSON lines, plain or compressed, leaving out malformed ones."""
    return parse_lines(configure(spark).read.text(path), schema)


def read_json_document(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    partitions: int | None = None,
) -> DataFrame:
    """Read files that each hold one JSON array (or object) into rows.

    Such a file cannot be split, so each is one task; ``partitions`` spreads
    the rows of few large files for the work that follows.
    """
    rows = spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST")
    return rows.repartition(partitions) if partitions else rows
