"""Table metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INFO = "name string, type string, nullable boolean, position int"


def schema_info(df: DataFrame, count_rows: bool = False) -> DataFrame:
    """One row ``name, type, nullable, position`` per column, and with
    ``count_rows`` the table's ``num_rows``."""
    spark = df.sparkSession
    fields = [
        (f.name, f.dataType.simpleString(), f.nullable, i)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    if not count_rows:
        return spark.createDataFrame(fields, _INFO)
    columns = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(dtype).alias("type"),
                F.lit(nullable).alias("nullable"),
                F.lit(position).alias("position"),
            )
            for name, dtype, nullable, position in fields
        ]
    )
    # The columns hang on the single row of the count, so nothing is joined.
    return (
        df.agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.inline(columns), "num_rows")
    )


def table_info(
    spark: SparkSession, table: str, count_rows: bool = False
) -> DataFrame:
    """``schema_info`` of a catalog table or view; no rows when it is absent."""
    if not spark.catalog.tableExists(table):
        schema = _INFO + (", num_rows bigint" if count_rows else "")
        return spark.createDataFrame([], schema)
    return schema_info(spark.table(table), count_rows)
