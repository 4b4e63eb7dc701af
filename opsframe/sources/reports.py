"""Raw CSV reports laid out as ``app_id=.../report_type=...``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.operators.columns import normalise_columns
from opsframe.operators.filters import since, until

# The report types that exist.
REPORT_TYPES = [
    "installs_report",
    "in_app_events_report",
    "in_app_events_retarget",
]


PARTITIONS = ("app_id", "report_type")


def read_report_csv(
    spark: SparkSession,
    root: str,
    report_type: str,
    app_id: str | list[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    time_column: str = "event_time",
    schema: T.StructType | str | None = None,
    quoted_newlines: bool = False,
) -> DataFrame:
    """One report type of one, several or all apps, column names normalised.

    Only the folders of that type are read, so its own files give the header
    and the types; app ids are text. ``schema`` names the columns as the file
    headers do, and a file with another header fails; without it the types are
    inferred by reading the files once more. ``quoted_newlines`` accepts line
    breaks inside quotes; a file is then read by one task as a whole.
    """
    if report_type not in REPORT_TYPES:
        raise ValueError(f"report_type must be one of {REPORT_TYPES}")
    folders = f"{root.rstrip('/')}/app_id=*/report_type={report_type}"
    reader = spark.read.options(
        header=True,
        escape='"',
        multiLine=quoted_newlines,
        mode="FAILFAST",
        basePath=root,
    )
    if schema is None:
        found = reader.options(inferSchema=True).csv(folders).schema
        fields = [f for f in found if f.name not in PARTITIONS]
        schema = T.StructType(fields)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    # Said to be text, app ids such as 007 are not taken for numbers.
    for name in PARTITIONS:
        schema = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    report = normalise_columns(
        reader.schema(schema).options(enforceSchema=False).csv(folders)
    )
    if app_id is not None:
        apps = [app_id] if isinstance(app_id, str) else list(app_id)
        report = report.filter(F.col("app_id").isin(apps))
    # An open end has no bound at all, so a sentinel date such as
    # 9999-12-31 is kept.
    if start is not None:
        report = since(report, time_column, start)
    if end is not None:
        report = until(report, time_column, end)
    return report
