"""Queries over the epoch, encoding and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import (
    base64_json,
    encode_base64,
    flatten_lists,
    from_micros,
    from_millis,
    to_millis,
)
from opsframe.plans.registry import query, table


@query(
    "to_millis",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS millis,
           CAST(trunc((epoch_us(ts) - 2000000000000000) / 1000) AS BIGINT)
             AS early_millis
    FROM events
    """,
)
def _to_millis(spark, sf_dir):
    # The shifted column lies before 1970, where truncation matters.
    early = F.timestamp_micros(
        F.unix_micros(F.col("ts").cast("timestamp"))
        - F.lit(2000000000000000)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        to_millis("ts").alias("millis"),
        to_millis(early).alias("early_millis"),
    )


@query(
    "from_millis",
    """
    SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts
    FROM events
    """,
)
def _from_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", from_millis(to_millis("ts")).alias("ts")
    )


@query("from_micros", "SELECT event_id, ts FROM events")
def _from_micros(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", from_micros(micros).alias("ts")
    )


@query(
    "base64_json",
    """
    SELECT event_id, to_base64(encode(props)) AS encoded,
           CAST(props->>'$.k' AS BIGINT) AS k
    FROM events
    """,
)
def _base64_json(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .select("event_id", encode_base64("props").alias("encoded"))
        .withColumn("k", base64_json("encoded", "k bigint").getField("k"))
    )


@query(
    "flatten_lists",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'N'
                THEN l_linestatus || ',' || l_shipdate::DATE
                ELSE l_returnflag || ',x,' || l_linestatus || ',' ||
                     l_shipdate::DATE END AS items
    FROM lineitem
    """,
)
def _flatten_lists(spark, sf_dir):
    nested = F.array(
        F.when(
            F.col("l_returnflag") != "N", F.array("l_returnflag", F.lit("x"))
        ),
        F.array(
            F.col("l_linestatus"), F.col("l_shipdate").cast("date").cast("string")
        ),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array_join(flatten_lists(nested), ",").alias("items"),
    )
