"""Structured Streaming: triggers in, events and job status out."""

from opsframe.streaming.publishing import (
    envelope,
    publish,
    publish_stream,
    topic_path,
)
from opsframe.streaming.status import (
    job_status,
    job_status_stream,
    log_batches,
)
from opsframe.streaming.triggers import (
    decode_trigger_stream,
    decode_triggers,
    encode_triggers,
    split_triggers,
)

__all__ = [
    "decode_trigger_stream",
    "decode_triggers",
    "encode_triggers",
    "envelope",
    "job_status",
    "job_status_stream",
    "log_batches",
    "publish",
    "publish_stream",
    "split_triggers",
    "topic_path",
]
