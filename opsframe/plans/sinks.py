"""Queries that write with a sink and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import batch_ids, content_types_map, message_requests
from opsframe.plans.registry import query, table
from opsframe.session import scratch_path
from opsframe.sinks import (
    append_rows,
    export_query,
    grid_update,
    json_line,
    write_json_gzip,
    write_json_lines,
)
from opsframe.sources import read_json_lines
from opsframe.streaming import envelope, publish

EXPORT = """
    SELECT o_custkey, o_orderpriority, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey, o_orderpriority
"""


@query(
    "append_rows",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
    FROM orders
    """,
)
def _append_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_orderpriority")
    closed = F.col("o_orderstatus") == "F"
    path = scratch_path(spark, "appended")
    append_rows(orders.filter(closed), path)
    append_rows(orders.filter(~closed), path)
    append_rows(orders.filter(F.lit(False)), path)
    return spark.read.parquet(path)


@query("export_query_csv", EXPORT)
def _export_query_csv(spark, sf_dir):
    path = scratch_path(spark, "export-csv")
    views = {"orders": table(spark, sf_dir, "orders")}
    export_query(spark, EXPORT, path, "CSV", views=views)
    schema = (
        "o_custkey bigint, o_orderpriority string, orders bigint, total double"
    )
    return spark.read.csv(
        path, schema, sep=";", header=True, escape='"', mode="FAILFAST"
    )


@query("export_query_json", EXPORT)
def _export_query_json(spark, sf_dir):
    path = scratch_path(spark, "export-json")
    views = {"orders": table(spark, sf_dir, "orders")}
    export_query(spark, EXPORT, path, "JSON", views=views)
    schema = (
        "o_custkey bigint, o_orderpriority string, orders bigint, total double"
    )
    return spark.read.json(path, schema, mode="FAILFAST")


@query(
    "json_line",
    """
    SELECT '{"event_type":"' || event_type || '","value":' ||
           to_json(value) || ',"props":' || to_json(props) || '}' AS value
    FROM events WHERE event_type <> 'error' AND event_type <> 'view'
    UNION ALL
    SELECT '{"value":' || to_json(value) || ',"props":' || to_json(props)
           || '}'
    FROM events WHERE event_type = 'view'
    """,
)
def _json_line(spark, sf_dir):
    error = F.col("event_type") == "error"
    named = ~F.col("event_type").isin("error", "view")
    return json_line(
        table(spark, sf_dir, "events").select(
            F.when(named, F.col("event_type")).alias("event_type"),
            F.when(~error, F.col("value")).alias("value"),
            F.when(~error, F.col("props")).alias("props"),
        )
    )


@query(
    "write_json_lines",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def _write_json_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "written-lines")
    early = F.col("event_type").isin("click", "view")
    write_json_lines(events.filter(early), path)
    write_json_lines(events.filter(~early), path)
    return read_json_lines(spark, path, events.schema)


@query(
    "write_json_gzip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
    " FROM customer",
)
def _write_json_gzip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "written-gzip")
    write_json_gzip(customer, path)
    return read_json_lines(spark, path, customer.schema)


@query(
    "publish",
    """
    SELECT 'projects/shop/topics/events' AS topic, props AS data,
           event_type AS event_type, CAST(user_id AS VARCHAR) AS user_id
    FROM events
    """,
)
def _publish(spark, sf_dir):
    messages = envelope(
        table(spark, sf_dir, "events"),
        "props",
        "shop",
        "events",
        {"type": F.col("event_type"), "user": F.col("user_id")},
    )
    path = scratch_path(spark, "topic")
    publish(messages, path)
    return spark.read.parquet(path).select(
        "topic",
        F.decode("data", "UTF-8").alias("data"),
        F.col("attributes")["type"].alias("event_type"),
        F.col("attributes")["user"].alias("user_id"),
    )


@query(
    "grid_update",
    """
    WITH placed AS (
      SELECT row_number() OVER (
               ORDER BY o_totalprice DESC, o_orderkey) + 2 AS row_idx,
             CAST(o_orderkey AS VARCHAR) AS k,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s,
             CAST(o_totalprice AS VARCHAR) AS p
      FROM orders
    ), sheet AS (
      SELECT c_custkey + 1 AS row_idx, c_name AS a, c_mktsegment AS b,
             'c' AS c, 'd' AS d
      FROM customer
    )
    SELECT CAST(coalesce(p.row_idx, g.row_idx) AS INTEGER) AS row_idx,
           g.a AS a, coalesce(p.k, g.b) AS b, coalesce(p.s, g.c) AS c,
           coalesce(p.p, g.d) AS d
    FROM sheet g FULL JOIN placed p ON g.row_idx = p.row_idx
    """,
)
def _grid_update(spark, sf_dir):
    grid = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).cast("int").alias("row_idx"),
        F.array(
            F.col("c_name"), F.col("c_mktsegment"), F.lit("c"), F.lit("d")
        ).alias("cells"),
    )
    values = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(
            F.col("o_orderstatus") != "P", F.col("o_orderstatus")
        ).alias("status"),
        "o_totalprice",
    )
    # The price lands in the third written column, under which the grid has
    # its "d".
    updated = grid_update(
        grid, "Sheet!B3", values, [F.desc("o_totalprice"), "o_orderkey"]
    )
    return updated.select(
        "row_idx",
        *[
            F.get("cells", F.lit(i)).alias(name)
            for i, name in enumerate("abcd")
        ],
    )


@query(
    "message_requests",
    """
    SELECT conv_id, turn,
           CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) // 100
                AS BIGINT) AS batch,
           '+852' || lpad(CAST(conv_id AS VARCHAR), 8, '0') AS "To",
           'MG' || role AS "From", text AS "Body", '' AS "ContentSid",
           CASE WHEN role = 'user' THEN '{"1":"' || turn || '"}' END
             AS "ContentVariables",
           'To=' || replace(url_encode('+852' ||
                    lpad(CAST(conv_id AS VARCHAR), 8, '0')), '%20', '+') ||
           '&From=MG' || role ||
           '&Body=' || replace(url_encode(text), '%20', '+') ||
           '&ContentSid=' ||
           CASE WHEN role = 'user'
                THEN '&ContentVariables=' ||
                     url_encode('{"1":"' || turn || '"}')
                ELSE '' END AS form
    FROM conversations
    """,
)
def _message_requests(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat(
            F.lit("+852"), F.lpad(F.col("conv_id").cast("string"), 8, "0")
        ).alias("recipient_phone"),
        F.concat(F.lit("MG"), "role").alias("messaging_service_sid"),
        F.col("text").alias("body"),
        F.lit(None).cast("string").alias("content_sid"),
        F.when(
            F.col("role") == "user",
            F.create_map(F.lit("1"), F.col("turn").cast("string")),
        ).alias("content_variables"),
    )
    batches = batch_ids(messages, 100, ["conv_id", "turn"])
    return message_requests(batches, keep=["conv_id", "turn", "batch"])


@query(
    "content_types_map",
    """
    WITH content AS (
      SELECT conv_id, turn, text AS body,
             CASE role WHEN 'user' THEN 'text'
                       WHEN 'assistant' THEN 'quick-reply'
                       ELSE 'list-picker' END AS category
      FROM conversations
    ), latest AS (
      SELECT conv_id, category, arg_max(body, turn) AS body,
             max(turn) AS turn
      FROM content GROUP BY conv_id, category
    )
    SELECT conv_id,
           '{' || string_agg(
             '"twilio/' || category || '":{"body":' || to_json(body) ||
             CASE category
               WHEN 'quick-reply' THEN ',"actions":[{"id":"' || turn || '"}]'
               WHEN 'list-picker'
                 THEN ',"items":[{"id":"' || turn || '"}],"button":"Open"'
               ELSE '' END || '}',
             ',' ORDER BY CASE category WHEN 'text' THEN 1
                               WHEN 'list-picker' THEN 2 ELSE 3 END) || '}'
           AS types
    FROM latest GROUP BY conv_id
    """,
)
def _content_types_map(spark, sf_dir):
    listed = F.array(
        F.create_map(F.lit("id"), F.col("turn").cast("string"))
    )
    content = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "text")
        .when(F.col("role") == "assistant", "quick-reply")
        .otherwise("list-picker")
        .alias("category"),
        F.col("text").alias("body"),
        listed.alias("actions"),
        listed.alias("items"),
        F.lit("Open").alias("button"),
    )
    return content_types_map(content, "conv_id", "turn")
