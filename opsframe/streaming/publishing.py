"""Event envelopes ``topic, data, attributes`` and their publication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def topic_path(project: str, topic: str) -> str:
    return f"projects/{project}/topics/{topic}"


def envelope(
    df: DataFrame,
    data: Column | str,
    project: str,
    topic: str,
    attributes: Mapping[str, Column | str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows as messages: UTF-8 ``data``, and attributes that are all text.

    An attribute given as a string is a constant. Works on streams too.
    """
    text = F.col(data) if isinstance(data, str) else data
    pairs = []
    for name, value in attributes.items():
        value = F.lit(value) if isinstance(value, str) else value
        pairs += [F.lit(name), value.cast("string")]
    named = (
        F.create_map(*pairs)
        if pairs
        else F.create_map().cast("map<string,string>")
    )
    return df.select(
        *(keep or []),
        F.lit(topic_path(project, topic)).alias("topic"),
        F.encode(text, "UTF-8").alias("data"),
        named.alias("attributes"),
    )


def publish(messages: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append a batch of envelopes to the topic's folder."""
    messages.write.mode("append").format(fmt).save(path)


def publish_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start appending a stream of envelopes to the topic's folder.

    The file sink commits each micro-batch once. ``available_now`` stops after
    the data at hand; otherwise the query runs on.
    """
    writer = (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
