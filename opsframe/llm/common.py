"""What the text operators share: tables, intermediate files and row helpers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.session import configure, scratch_path

# Rows handed to a Python worker at once, and bytes for each of them; a batch
# ends with whichever comes first.
BATCH_ROWS = 2000
ROW_BYTES = 8 << 10


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """The session with the settings the text operators rely on."""
    configure(spark)
    batch = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(rows * ROW_BYTES),
    }
    for key, value in batch.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read from there.

    Later plans start from the files, so that losing an executor costs no more
    than the tasks it ran, and work that several branches need is done once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """A text column as its UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from Python lists or Arrow arrays in schema order."""
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, pa.Array) else pa.array(c, field.type)
            for c, field in zip(columns, schema)
        ],
        schema=schema,
    )
