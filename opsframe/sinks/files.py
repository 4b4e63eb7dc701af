"""Sinks that write files or append to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import KEEP_NULLS, TIME_FORMATS
from opsframe.sources.warehouse import run_sql

_UNORDERED = (T.MapType, T.VariantType, T.CalendarIntervalType)


def append_rows(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append to a catalog table, or to a folder when ``table`` has a ``/``.

    The rows are committed together, and a row that does not fit fails the
    write. No rows add nothing.
    """
    writer = df.write.mode("append").format(fmt)
    if "/" in table:
        writer.save(table)
    else:
        writer.saveAsTable(table)


def export_query(
    spark: SparkSession,
    query: str,
    path: str,
    fmt: str = "CSV",
    args: dict | None = None,
    views: dict[str, DataFrame] | None = None,
) -> None:
    """Run SQL and overwrite a folder with the result, sorted by its first
    column, as CSV (``;``, header) or JSON lines."""
    if fmt not in ("CSV", "JSON"):
        raise ValueError("fmt must be CSV or JSON")
    export_frame(run_sql(spark, query, args, views), path, fmt)


def export_frame(df: DataFrame, path: str, fmt: str = "CSV") -> None:
    """The writing half of ``export_query``."""
    # The other columns break ties, so that a frequent first value is spread
    # over several sort ranges.
    order = [
        F.col(f"`{f.name}`")
        for i, f in enumerate(df.schema.fields)
        if i == 0 or not isinstance(f.dataType, _UNORDERED)
    ]
    writer = df.orderBy(*order).write.mode("overwrite").options(**TIME_FORMATS)
    if fmt == "CSV":
        writer.options(sep=";", header=True, escape='"').csv(path)
    else:
        writer.json(path)


def json_line(
    df: DataFrame, output: str = "value", keep_nulls: bool = False
) -> DataFrame:
    """One JSON object per row as text; rows without any value are left out."""
    options = KEEP_NULLS if keep_nulls else TIME_FORMATS
    columns = [F.col(f"`{c}`") for c in df.columns]
    text = F.to_json(F.struct(*columns), options)
    return df.select(text.alias(output)).filter(F.col(output) != "{}")


def write_json_lines(
    df: DataFrame,
    path: str,
    mode: str = "append",
    keep_nulls: bool = False,
    compression: str | None = None,
) -> None:
    """Write JSON lines, appending by default."""
    writer = json_line(df, keep_nulls=keep_nulls).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_json_gzip(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write gzip JSON lines."""
    write_json_lines(df, path, mode, compression="gzip")
