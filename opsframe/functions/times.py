"""Epoch conversions. Zone-less timestamps are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_millis(ts: Column | str) -> Column:
    """Timestamp -> epoch milliseconds, truncated toward zero."""
    micros = F.unix_micros(_column(ts).cast("timestamp"))
    # unix_millis floors, which differs for fractions before 1970.
    return F.call_function("div", micros, F.lit(1000))


def from_millis(millis: Column | str) -> Column:
    """Epoch milliseconds -> UTC timestamp without zone."""
    return F.timestamp_millis(_column(millis)).cast("timestamp_ntz")


def from_micros(micros: Column | str) -> Column:
    """Epoch microseconds -> UTC timestamp without zone."""
    return F.timestamp_micros(_column(micros)).cast("timestamp_ntz")
