"""Trigger messages: base64 of JSON in a ``data`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import (
    TIME_FORMATS,
    base64_json,
    encode_base64,
    is_json,
)

TRIGGER_SCHEMA = "message_id bigint, data string"


def encode_triggers(
    df: DataFrame, columns: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Rows -> trigger messages carrying the named columns."""
    text = F.to_json(F.struct(*columns), TIME_FORMATS)
    return df.select(*(keep or []), encode_base64(text).alias("data"))


def decode_triggers(
    messages: DataFrame,
    schema: T.StructType | str,
    data: str = "data",
    output: str = "context",
    strict: bool = True,
) -> DataFrame:
    """Replace ``data`` by the decoded task context. Works on streams too."""
    return messages.withColumn(
        output, base64_json(data, schema, strict)
    ).drop(data)


def split_triggers(
    messages: DataFrame,
    schema: T.StructType | str,
    data: str = "data",
    output: str = "context",
) -> tuple[DataFrame, DataFrame]:
    """``(decoded messages, rejected messages)``. A message whose data is no
    JSON of the schema is rejected as it is, instead of ending the stream.
    Works on streams too, with a query for each of the two."""
    # Neither bad base64 nor bad UTF-8 nor bad JSON may raise.
    text = F.try_validate_utf8(
        F.try_to_binary(data, F.lit("base64")).cast("string")
    )
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(text, marked, {"columnNameOfCorruptRecord": "_bad"})
    fits = (
        is_json(text)
        & F.ltrim(text).startswith("{")
        & F.col("_parsed._bad").isNull()
    )
    fields = F.struct(*[F.col(f"_parsed.`{n}`").alias(n) for n in names])
    decoded = messages.withColumn("_parsed", parsed).withColumn(
        output, F.when(fits, fields)
    ).drop("_parsed")
    good = decoded.filter(F.col(output).isNotNull()).drop(data)
    return good, decoded.filter(F.col(output).isNull()).drop(output)


def decode_trigger_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    message_schema: T.StructType | str = TRIGGER_SCHEMA,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    strict: bool = True,
) -> DataFrame:
    """A stream of task contexts from trigger messages landing in a folder."""
    reader = spark.readStream.format(fmt).schema(message_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode_triggers(reader.load(path), schema, strict=strict)
