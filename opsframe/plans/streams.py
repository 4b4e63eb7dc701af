"""Streaming queries. Each runs over the events at hand and stops; its result
is what it wrote."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from opsframe.plans.registry import query, table
from opsframe.session import scratch_path
from opsframe.streaming import (
    decode_trigger_stream,
    encode_triggers,
    envelope,
    job_status_stream,
    publish_stream,
    split_triggers,
)

# Micro-batches of a stream over the trigger folder, and its files at least.
BATCHES = 4
# Rows of a file: more rows give more files, so that one batch fills a cluster.
FILE_ROWS = 200_000
CONTEXT = "event_id bigint, event_type string, value double"


def _files(rows):
    """Files of a trigger folder: as many for each of the micro-batches."""
    return BATCHES * max(1, math.ceil(rows / (BATCHES * FILE_ROWS)))


def _trigger_folder(spark, sf_dir):
    """The events as trigger messages in a folder."""
    path = scratch_path(spark, "triggers")
    events = table(spark, sf_dir, "events")
    # The rows of Parquet files are counted from their footers.
    events = events.repartition(_files(events.count()))
    encode_triggers(
        events.withColumn("message_id", F.col("event_id")),
        ["event_id", "event_type", "value"],
        keep=["message_id"],
    ).write.parquet(path)
    return path


def _finish(stream):
    stream.awaitTermination()


@query(
    "decode_trigger_stream",
    "SELECT event_id AS message_id, event_id, event_type, value FROM events",
)
def _decode_trigger_stream(spark, sf_dir):
    contexts = decode_trigger_stream(
        spark, _trigger_folder(spark, sf_dir), CONTEXT
    )
    out = scratch_path(spark, "decoded")
    _finish(
        contexts.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.parquet(out).select("message_id", "context.*")


@query(
    "publish_stream",
    """
    SELECT 'projects/shop/topics/triggers' AS topic, event_type AS type,
           CAST(event_id AS VARCHAR) AS id, event_id, event_type, value,
           3 AS fields
    FROM events
    """,
)
def _publish_stream(spark, sf_dir):
    contexts = decode_trigger_stream(
        spark, _trigger_folder(spark, sf_dir), CONTEXT
    )
    messages = envelope(
        contexts,
        F.to_json("context"),
        "shop",
        "triggers",
        {"type": F.col("context.event_type"), "id": F.col("message_id")},
    )
    out = scratch_path(spark, "published")
    _finish(
        publish_stream(messages, out, scratch_path(spark, "checkpoint"))
    )
    data = F.decode("data", "UTF-8")
    return spark.read.parquet(out).select(
        "topic",
        F.col("attributes")["type"].alias("type"),
        F.col("attributes")["id"].alias("id"),
        F.from_json(data, CONTEXT).alias("context"),
        F.size(F.map_keys(F.from_json(data, "map<string,string>"))).alias("fields"),
    ).select("topic", "type", "id", "context.*", "fields")


@query(
    "split_triggers",
    """
    SELECT event_id AS message_id,
           event_type NOT IN ('error', 'view') AS good,
           CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value
    FROM events
    """,
)
def _split_triggers(spark, sf_dir):
    """One stream of the messages that decode and one of those that don't."""
    folder = scratch_path(spark, "mixed")
    messages = spark.read.parquet(_trigger_folder(spark, sf_dir)).join(
        table(spark, sf_dir, "events").select(
            F.col("event_id").alias("message_id"), "event_type"
        ),
        "message_id",
    )
    broken = (
        F.when(F.col("event_type") == "error", F.lit("%% no base64"))
        .when(F.col("event_type") == "view", F.base64(F.lit('{"event_id": "x"')))
        .otherwise(F.col("data"))
    )
    messages.select("message_id", broken.alias("data")).write.parquet(folder)
    source = spark.readStream.schema("message_id bigint, data string")
    good, rejected = split_triggers(source.parquet(folder), CONTEXT)
    written = []
    for part in (
        good.select("message_id", F.lit(True).alias("good"), "context.value"),
        rejected.select(
            "message_id",
            F.lit(False).alias("good"),
            F.lit(None).cast("double").alias("value"),
        ),
    ):
        out = scratch_path(spark, "part")
        _finish(
            part.writeStream.format("parquet")
            .option("checkpointLocation", scratch_path(spark, "checkpoint"))
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )
        written.append(spark.read.schema(part.schema).parquet(out))
    return written[0].unionByName(written[1])


@query(
    "job_status_stream",
    """
    SELECT service, result, event_id FROM events,
           (VALUES ('importer', 'ran'), ('importer', 'succeeded'),
                   ('exporter', 'ran'), ('exporter', 'failed'))
             t(service, result)
    """,
)
def _job_status_stream(spark, sf_dir):
    triggers = _trigger_folder(spark, sf_dir)
    files = _files(table(spark, sf_dir, "events").count())
    statuses = scratch_path(spark, "status")

    def start(service, work, files):
        return job_status_stream(
            decode_trigger_stream(
                spark, triggers, CONTEXT, files_per_batch=files
            ),
            work,
            f"{statuses}/{service}",
            scratch_path(spark, "checkpoint"),
            "shop",
            "status",
            service,
        )

    copied = scratch_path(spark, "work")

    def copy(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{copied}/batch_id={batch_id}")

    def break_down(batch, batch_id):
        raise ValueError("the work of this service fails")

    _finish(start("importer", copy, files // BATCHES))
    # The failing service takes all in one batch, as its first is its last.
    failing = start("exporter", break_down, files)
    try:
        failing.awaitTermination()
    except Exception as error:
        if "the work of this service fails" not in str(error):
            raise
    written = [
        spark.read.parquet(f"{statuses}/{service}")
        for service in ("importer", "exporter")
    ]
    data = F.decode("data", "UTF-8")
    return (
        written[0]
        .unionByName(written[1])
        .select(
            F.col("attributes")["service"].alias("service"),
            F.col("attributes")["result"].alias("result"),
            F.get_json_object(data, "$.event_id")
            .cast("bigint")
            .alias("event_id"),
        )
    )
