"""Queries over nested records. Each record is built from one line item, so
that no group of rows has to be gathered first."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import (
    nested_to_string,
    numeric_hook,
    parse_json_numeric,
)
from opsframe.operators import find_paths, leaf_paths, node_map
from opsframe.plans.registry import query, table

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _records(spark, sf_dir):
    """Line items as nested records:

    ``{"order": {"key", "line": {"no"}}, "qty", "codes": [flag, status],
    "parties": [{"id"}, {"id", "role"}], "note"?}``
    """
    flag = F.col("l_returnflag")
    party = "struct<id:bigint,role:string>"
    used = [*KEYS, "l_quantity", "l_returnflag", "l_linestatus"]
    return table(spark, sf_dir, "lineitem", used).select(
        *KEYS,
        F.struct(
            F.struct(
                F.col("l_orderkey").alias("key"),
                F.struct(F.col("l_linenumber").alias("no")).alias("line"),
            ).alias("order"),
            F.col("l_quantity").cast("int").alias("qty"),
            F.array("l_returnflag", "l_linestatus").alias("codes"),
            F.array(
                F.struct(
                    F.col("l_partkey").alias("id"),
                    F.lit(None).cast("string").alias("role"),
                ).cast(party),
                F.struct(
                    F.col("l_suppkey").alias("id"),
                    F.lit("supplier").alias("role"),
                ).cast(party),
            ).alias("parties"),
            F.when(flag == "A", "back\"order").alias("note"),
        ).alias("record"),
    )


NODE_ROWS = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, n.path, n.value
    FROM (
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, unnest([
        {'path': 'order.key', 'value': l_orderkey::VARCHAR},
        {'path': 'order.line.no', 'value': l_linenumber::VARCHAR},
        {'path': 'qty', 'value': l_quantity::INTEGER::VARCHAR},
        {'path': 'codes', 'value': '["' || l_returnflag || '","' ||
                                   l_linestatus || '"]'},
        {'path': 'codes', 'value': '["' || l_returnflag || '","' ||
                                   l_linestatus || '"]'},
        {'path': 'parties.id', 'value': l_partkey::VARCHAR},
        {'path': 'parties.id', 'value': l_suppkey::VARCHAR},
        {'path': 'parties.role', 'value': '"supplier"'},
        CASE WHEN l_returnflag = 'A'
             THEN {'path': 'note', 'value': '"back\\"order"'} END
      ]) AS n
      FROM lineitem)
    WHERE n IS NOT NULL
"""


@query("node_map", NODE_ROWS)
def _node_map(spark, sf_dir):
    return node_map(_records(spark, sf_dir), "record", KEYS)


@query("node_map_variant", NODE_ROWS)
def _node_map_variant(spark, sf_dir):
    text = _records(spark, sf_dir).withColumn("record", F.to_json("record"))
    parsed = text.withColumn("record", F.parse_json("record"))
    return node_map(parsed, "record", KEYS)


@query(
    "node_map_elements",
    """
    SELECT event_id, 'k' AS path, CAST(props->>'$.k' AS VARCHAR) AS value
    FROM events
    UNION ALL
    SELECT event_id, 'tags', to_json(event_type) FROM events
    UNION ALL
    SELECT event_id, 'tags', CAST(user_id AS VARCHAR) FROM events
    """,
)
def _node_map_elements(spark, sf_dir):
    # The events' own JSON with a mixed list added, read without a schema.
    text = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"),
        F.lit(',"tags":["'),
        "event_type",
        F.lit('",'),
        "user_id",
        F.lit("]}"),
    )
    used = ["event_id", "event_type", "user_id", "props"]
    events = table(spark, sf_dir, "events", used).select(
        "event_id", F.parse_json(text).alias("record")
    )
    return node_map(events, "record", lists="element", max_depth=1)


FOUND_ROWS = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           l_linenumber::VARCHAR AS order_line_no,
           '[' || l_partkey || ',' || l_suppkey || ']' AS parties_id,
           '"supplier"' AS parties_role,
           CASE WHEN l_returnflag = 'A' THEN '"back\\"order"' END AS note,
           CASE WHEN l_returnflag = 'A' THEN '' ELSE 'note' END AS missing
    FROM lineitem
"""


@query("find_paths", FOUND_ROWS)
def _find_paths(spark, sf_dir):
    paths = ["order.line.no", "parties.id", "parties.role", "note"]
    found = find_paths(_records(spark, sf_dir), "record", paths)
    return found.drop("record").withColumn(
        "missing", F.array_join("missing", ",")
    )


@query(
    "leaf_paths",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           'order.key,order.line.no,qty,codes,parties' ||
           CASE WHEN l_returnflag = 'A' THEN ',note' ELSE '' END AS paths
    FROM lineitem
    """,
)
def _leaf_paths(spark, sf_dir):
    found = leaf_paths(_records(spark, sf_dir), "record")
    return found.select(*KEYS, F.array_join("paths", ",").alias("paths"))


@query(
    "nested_to_string",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag,
           '{"key":' || l_orderkey || ',"line":' || l_linenumber || '}'
             AS "order",
           '["' || l_returnflag || '","' || l_linestatus || '"]' AS codes,
           CASE WHEN l_returnflag <> 'R' THEN CAST(l_discount AS VARCHAR)
                ELSE 'null' END AS discount
    FROM lineitem
    """,
)
def _nested_to_string(spark, sf_dir):
    return nested_to_string(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            F.struct(
                F.col("l_orderkey").alias("key"),
                F.col("l_linenumber").alias("line"),
            ).alias("order"),
            F.array("l_returnflag", "l_linestatus").alias("codes"),
            F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias(
                "discount"
            ),
        )
    )


@query(
    "numeric_hook",
    """
    SELECT CAST(event_id AS DOUBLE) AS event_id,
           CASE WHEN event_type = 'click' THEN 1::DOUBLE ELSE 0::DOUBLE END
             AS clicked,
           t AS mixed,
           CASE WHEN event_type IN ('click', 'view')
                THEN CAST(user_id AS DOUBLE)
                WHEN event_type = 'signup' THEN 1000::DOUBLE + user_id
                WHEN event_type = 'purchase' THEN -0.25::DOUBLE * user_id END
             AS mixed_num
    FROM (
      SELECT event_id, event_type, user_id,
             CASE event_type
               WHEN 'click' THEN ' ' || user_id || ' '
               WHEN 'view' THEN '+' || user_id || '.0'
               WHEN 'signup' THEN '1_' || lpad(CAST(user_id AS VARCHAR), 3, '0')
               WHEN 'purchase' THEN '-' || (user_id * 25) || 'e-2'
               ELSE user_id || 'd' END AS t
      FROM (SELECT event_id, event_type, user_id % 1000 AS user_id
            FROM events))
    """,
)
def _numeric_hook(spark, sf_dir):
    kind = F.col("event_type")
    user = F.col("user_id") % 1000
    mixed = (
        F.when(kind == "click", F.concat(F.lit(" "), user, F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("+"), user, F.lit(".0")))
        .when(
            kind == "signup",
            F.concat(F.lit("1_"), F.lpad(user.cast("string"), 3, "0")),
        )
        .when(
            kind == "purchase", F.concat(F.lit("-"), user * 25, F.lit("e-2"))
        )
        .otherwise(F.concat(user, F.lit("d")))
    )
    return numeric_hook(
        table(spark, sf_dir, "events").select(
            "event_id", (kind == "click").alias("clicked"), mixed.alias("mixed")
        )
    )


PARSED_ROWS = """
    SELECT event_id,
           CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS DOUBLE)
           END AS k,
           CASE WHEN event_type <> 'error' THEN 1::DOUBLE END AS active,
           CASE WHEN event_type <> 'error' THEN event_type END AS inner_name,
           CASE WHEN event_type <> 'error' THEN value END AS inner_size_num,
           CASE WHEN event_type <> 'error' THEN user_id END AS first_item
    FROM events
"""


def _parsed(spark, sf_dir, schema):
    events = table(
        spark, sf_dir, "events", ["event_id", "event_type", "user_id", "value", "props"]
    )
    text = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"),
        F.lit(',"active":true,"list":['),
        "user_id",
        F.lit('],"inner":[{"name":"'),
        "event_type",
        F.lit('","size":"'),
        "value",
        F.when(F.col("event_type") == "error", '"').otherwise('"}]}'),
    )
    parsed = parse_json_numeric(
        events.select("event_id", text.alias("text")), "text", schema
    )
    return parsed.select(
        "event_id",
        "parsed.k",
        "parsed.active",
        F.col("parsed.inner")[0]["name"].alias("inner_name"),
        F.col("parsed.inner")[0]["size_num"].alias("inner_size_num"),
        F.col("parsed.list")[0].alias("first_item"),
    )


@query("parse_json_numeric", PARSED_ROWS)
def _parse_json_numeric(spark, sf_dir):
    return _parsed(
        spark,
        sf_dir,
        "k bigint, active boolean, list array<bigint>,"
        " inner array<struct<name:string,size:string>>",
    )


@query("parse_json_numeric_inferred", PARSED_ROWS)
def _parse_json_numeric_inferred(spark, sf_dir):
    return _parsed(spark, sf_dir, None)
