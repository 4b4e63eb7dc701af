"""Queries over renaming, projection and filters."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from opsframe.operators import (
    date_range,
    filter_groups,
    incremental_pull,
    lookup_batch,
    normalise_columns,
    optional_filters,
    pascal_columns,
    select_properties,
    since,
    sparse_record,
)
from opsframe.plans.registry import query, table


@query(
    "calls_after",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01'
      AND o_orderstatus = 'F' AND o_totalprice >= 100000
      AND o_custkey IN (SELECT c_custkey FROM customer
                        WHERE c_mktsegment = 'MACHINERY')
    """,
)
def calls_after(spark, sf_dir):
    """Filter groups, a cutoff, a key list and a projection together."""
    keys = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    calls = filter_groups(
        table(spark, sf_dir, "orders"),
        [
            {"propertyName": "o_orderstatus", "operator": "EQ", "value": "F"},
            {
                "propertyName": "o_totalprice",
                "operator": "GTE",
                "value": 100000,
            },
        ],
    )
    recent = since(calls, "o_orderdate", datetime(1998, 1, 1))
    return lookup_batch(
        recent,
        keys,
        "o_custkey",
        ["o_orderkey", "o_totalprice", "o_orderdate"],
    )


@query(
    "normalise_columns",
    """
    SELECT event_id, ts AS event_time, event_type AS event_name FROM events
    """,
)
def _normalise_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event ID"),
        F.col("ts").alias("Event Time"),
        F.col("event_type").alias("EVENT NAME"),
    )
    return normalise_columns(events)


@query(
    "pascal_columns",
    """
    SELECT c_custkey AS "CCustkey", c_name AS "CName",
           c_nationkey AS "CNationkey", c_acctbal AS "CAcctbal",
           c_mktsegment AS "CMktsegment"
    FROM customer
    """,
)
def _pascal_columns(spark, sf_dir):
    return pascal_columns(table(spark, sf_dir, "customer"))


@query(
    "select_properties",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
)
def _select_properties(spark, sf_dir):
    return select_properties(
        table(spark, sf_dir, "customer"),
        ["c_mktsegment", "c_acctbal"],
        always=["c_custkey"],
    )


@query(
    "filter_groups",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders
    WHERE (o_orderstatus = 'O' AND o_totalprice > 250000)
       OR (o_orderpriority <> '5-LOW' AND o_totalprice <= 20000
           AND o_orderdate < TIMESTAMP '1996-01-01')
    """,
)
def _filter_groups(spark, sf_dir):
    def item(name, operator, value):
        return {"propertyName": name, "operator": operator, "value": value}

    groups = [
        [item("o_orderstatus", "EQ", "O"), item("o_totalprice", "GT", 250000)],
        [
            item("o_orderpriority", "NEQ", "5-LOW"),
            item("o_totalprice", "LTE", 20000),
            item("o_orderdate", "LT", 820454400000),
        ],
    ]
    return filter_groups(table(spark, sf_dir, "orders"), groups).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query(
    "since",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1999-06-01'
    """,
)
def _since(spark, sf_dir):
    return since(
        table(spark, sf_dir, "orders"), "o_orderdate", 928195200000
    ).select("o_orderkey", "o_orderdate")


@query(
    "incremental_pull",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01'
      AND NOT (o_orderdate < TIMESTAMP '1998-01-02' AND o_orderstatus = 'F')
    """,
)
def _incremental_pull(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    seen = date_range(
        orders, "o_orderdate", date(1998, 1, 1), date(1998, 1, 1)
    ).filter(F.col("o_orderstatus") == "F")
    return incremental_pull(
        orders,
        "o_orderdate",
        date(1998, 1, 1),
        "o_orderkey",
        seen.select("o_orderkey", "o_orderdate"),
    ).select("o_orderkey", "o_orderdate")


@query(
    "incremental_pull_latest",
    """
    WITH calls AS (
      SELECT event_id, ts, event_type,
             CASE WHEN event_type <> 'signup' THEN user_id END AS user_id
      FROM events
    ), fresh AS (
      SELECT * FROM calls WHERE ts >= TIMESTAMP '2024-01-15'
    )
    SELECT event_id, user_id, ts, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r
      FROM fresh WHERE user_id IS NOT NULL
    ) WHERE r = 1
    UNION ALL
    SELECT event_id, user_id, ts, event_type FROM fresh WHERE user_id IS NULL
    """,
)
def _incremental_pull_latest(spark, sf_dir):
    # Sign-ups are calls before a user exists: their key is NULL, and every
    # one of them comes back.
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias(
            "user_id"
        ),
    )
    return incremental_pull(
        events, "ts", date(2024, 1, 15), "user_id", latest=True
    ).select("event_id", "user_id", "ts", "event_type")


@query(
    "date_range",
    """
    SELECT event_id, ts, event_type FROM events
    WHERE ts >= DATE '2024-01-03' AND ts < DATE '2024-01-11'
    """,
)
def _date_range(spark, sf_dir):
    return date_range(
        table(spark, sf_dir, "events"),
        "ts",
        date(2024, 1, 3),
        date(2024, 1, 10),
    ).select("event_id", "ts", "event_type")


@query(
    "optional_filters",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE event_type = 'click'
      AND ts >= DATE '2024-01-05' AND ts < DATE '2024-01-06'
    """,
)
def _optional_filters(spark, sf_dir):
    return optional_filters(
        table(spark, sf_dir, "events"),
        ts=date(2024, 1, 5),
        event_type="click",
        user_id=None,
    ).select("event_id", "user_id", "event_type")


@query(
    "sparse_record",
    """
    SELECT c_custkey,
           '{"CCustkey":' || c_custkey ||
           CASE WHEN c_nationkey <> 0
                THEN ',"CNationkey":' || c_nationkey ELSE '' END ||
           CASE WHEN c_acctbal > 0 THEN ',"IsActive":true' ELSE '' END ||
           CASE WHEN c_mktsegment <> 'BUILDING'
                THEN ',"CMktsegment":"' || c_mktsegment || '"' ELSE '' END ||
           '}' AS record
    FROM customer
    WHERE (c_nationkey <> 0 OR c_acctbal > 0 OR c_mktsegment <> 'BUILDING')
    UNION ALL
    SELECT c_custkey, NULL FROM customer
    WHERE NOT (c_nationkey <> 0 OR c_acctbal > 0
               OR c_mktsegment <> 'BUILDING')
    """,
)
def _sparse_record(spark, sf_dir):
    updates = (
        table(spark, sf_dir, "customer")
        .select(
            "c_custkey",
            "c_nationkey",
            (F.col("c_acctbal") > 0).alias("is_active"),
            F.when(F.col("c_mktsegment") == "BUILDING", "")
            .otherwise(F.col("c_mktsegment"))
            .alias("c_mktsegment"),
        )
    )
    records, rejected = sparse_record(updates, "c_custkey", mode="split")
    return records.select("c_custkey", "record").unionByName(
        rejected.select("c_custkey", F.lit(None).alias("record"))
    )


@query(
    "filter_date_column",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) >= DATE '1997-03-02'
      AND CAST(o_orderdate AS DATE) <= DATE '1998-01-01'
      AND o_totalprice > 1000.5
    """,
)
def _filter_date_column(spark, sf_dir):
    """Times of day and epoch milliseconds against dates; a decimal price."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("day"),
    )
    recent = since(orders, "day", datetime(1997, 3, 1, 12))
    groups = [
        {"propertyName": "day", "operator": "LT", "value": 883699200000 - 1},
        {
            "propertyName": "o_totalprice",
            "operator": "GT",
            "value": Decimal("1000.5"),
        },
    ]
    return filter_groups(recent, groups).select("o_orderkey", "day")
