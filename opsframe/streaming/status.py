"""Job status events around the work on each micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.functions.json_text import TIME_FORMATS
from opsframe.streaming.publishing import envelope

RAN, SUCCEEDED, FAILED = "ran", "succeeded", "failed"
RESULTS = (RAN, FAILED, SUCCEEDED)


def job_status(
    contexts: DataFrame,
    context: str,
    result: str,
    project: str,
    topic: str,
    attributes: Mapping[str, str],
) -> DataFrame:
    """One status message per task context."""
    if result not in RESULTS:
        raise ValueError(f"result must be one of {RESULTS}")
    return envelope(
        contexts,
        F.to_json(context, TIME_FORMATS),
        project,
        topic,
        {**attributes, "result": result},
    )


def log_batches(
    work: Callable[[DataFrame, int], None],
    status_path: str,
    project: str,
    topic: str,
    service: str,
    context: str = "context",
) -> Callable[[DataFrame, int], None]:
    """Wrap a ``foreachBatch`` function so that it reports its progress.

    Every task context in the batch gets a ``ran`` message first and then
    ``succeeded`` or ``failed``; a failure is raised again. A batch writes
    each result to its own folder ``batch_id=/result=`` and overwrites it, so
    a batch that is run again leaves one message per context and result. The
    contexts are made into messages once: those of the outcome are the stored
    ``ran`` messages with another result.
    """

    def target(batch_id: int, result: str) -> str:
        return f"{status_path}/batch_id={batch_id}/result={result}"

    def report(messages: DataFrame, batch_id: int, result: str) -> None:
        messages.write.mode("overwrite").parquet(target(batch_id, result))

    def outcome(ran: DataFrame, batch_id: int, result: str) -> None:
        stored = ran.sparkSession.read.schema(ran.schema).parquet(
            target(batch_id, RAN)
        )
        others = F.map_filter("attributes", lambda name, _: name != "result")
        named = F.map_concat(others, F.create_map(F.lit("result"), F.lit(result)))
        report(stored.withColumn("attributes", named), batch_id, result)

    def run(batch: DataFrame, batch_id: int) -> None:
        ran = job_status(
            batch, context, RAN, project, topic, {"service": service}
        )
        report(ran, batch_id, RAN)
        try:
            work(batch, batch_id)
        except Exception:
            outcome(ran, batch_id, FAILED)
            raise
        outcome(ran, batch_id, SUCCEEDED)

    return run


def job_status_stream(
    contexts: DataFrame,
    work: Callable[[DataFrame, int], None],
    status_path: str,
    checkpoint: str,
    project: str,
    topic: str,
    service: str,
    context: str = "context",
    available_now: bool = True,
):
    """Start a query that does ``work`` on each micro-batch and reports it."""
    writer = contexts.writeStream.foreachBatch(
        log_batches(work, status_path, project, topic, service, context)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
