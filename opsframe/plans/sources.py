"""Queries over the sources. Files are first derived from the tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from opsframe.functions.json_text import TIME_FORMATS
from opsframe.operators import batch_ids
from opsframe.plans.registry import query, table
from opsframe.session import scratch_path
from opsframe.sources import (
    REPORT_TYPES,
    grid_range_frame,
    list_files,
    missing_pages,
    next_token,
    read_files_binary,
    read_json_document,
    read_json_lines,
    read_pages,
    read_report_csv,
    run_sql,
    table_info,
)

PAGE_ITEMS = 100
DOCUMENT_ROWS = 10_000


@query(
    "read_json_lines",
    """
    WITH good AS (
      SELECT event_type, event_id,
             '{"event_id":' || event_id || ',"user_id":' || user_id ||
             ',"event_type":"' || event_type || '","props":' || props || '}'
               AS line
      FROM events
    ), lines AS (
      SELECT line FROM good
      UNION ALL
      SELECT left(line, length(line) - 1) FROM good WHERE event_type = 'error'
      UNION ALL
      SELECT line || ' x' FROM good WHERE event_type = 'click'
      UNION ALL
      SELECT CAST(event_id AS VARCHAR) FROM good WHERE event_type = 'view'
    )
    SELECT CAST(line->>'$.event_id' AS BIGINT) AS event_id,
           CAST(line->>'$.user_id' AS BIGINT) AS user_id,
           line->>'$.event_type' AS event_type,
           CAST(line->>'$.props.k' AS BIGINT) AS k
    FROM lines WHERE json_valid(line)
    """,
)
def _read_json_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    good = F.concat(
        F.lit('{"event_id":'),
        F.col("event_id"),
        F.lit(',"user_id":'),
        F.col("user_id"),
        F.lit(',"event_type":"'),
        F.col("event_type"),
        F.lit('","props":'),
        F.col("props"),
        F.lit("}"),
    )
    # Broken, overlong and scalar lines go between the good ones.
    extra = (
        F.when(
            F.col("event_type") == "error",
            F.substring(good, F.lit(1), F.length(good) - 1),
        )
        .when(F.col("event_type") == "click", F.concat(good, F.lit(" x")))
        .when(F.col("event_type") == "view", F.col("event_id").cast("string"))
    )
    lines = events.select(F.explode(F.array(good, extra)).alias("value"))
    path = scratch_path(spark, "lines")
    lines.filter(F.col("value").isNotNull()).write.text(path)
    schema = (
        "event_id bigint, user_id bigint, event_type string,"
        " props struct<k:bigint>"
    )
    return read_json_lines(spark, path, schema).select(
        "event_id", "user_id", "event_type", F.col("props.k").alias("k")
    )


@query(
    "read_json_document",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    """,
)
def _read_json_document(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    # Numbered batches, so that no document can outgrow its bound.
    documents = (
        batch_ids(customer, DOCUMENT_ROWS, "c_custkey", "document")
        .groupBy("document")
        .agg(F.collect_list(F.to_json(F.struct(*customer.columns))).alias("_r"))
        .select(
            "document",
            F.concat(
                F.lit("["), F.array_join("_r", ","), F.lit("]")
            ).alias("value"),
        )
    )
    path = scratch_path(spark, "documents")
    # One document per file, all in one folder.
    documents.repartition("document").select("value").write.option(
        "maxRecordsPerFile", 1
    ).option("compression", "gzip").text(path)
    return read_json_document(spark, path, customer.schema).select(
        *customer.columns
    )


@query(
    "read_report_csv",
    """
    SELECT CASE event_type
             WHEN 'signup' THEN 'installs_report'
             WHEN 'purchase' THEN 'in_app_events_retarget'
             ELSE 'in_app_events_report' END AS report_type,
           lpad(CAST(user_id % 7 AS VARCHAR), 3, '0') AS app_id,
           event_id, ts AS event_time, event_type AS event_name,
           user_id AS customer_user_id,
           value AS event_value
    FROM events
    WHERE ts >= DATE '2024-01-02' AND ts < DATE '2024-01-21'
    """,
)
def _read_report_csv(spark, sf_dir):
    """Types with one header, read by a given schema."""
    events = table(spark, sf_dir, "events")
    installs, in_app, retarget = REPORT_TYPES
    reports = events.select(
        F.col("event_id").alias("Event ID"),
        F.col("ts").alias("Event Time"),
        F.col("event_type").alias("Event Name"),
        F.col("user_id").alias("Customer User ID"),
        F.col("value").alias("Event Value"),
        _app_id(),
        F.when(F.col("event_type") == "signup", installs)
        .when(F.col("event_type") == "purchase", retarget)
        .otherwise(in_app)
        .alias("report_type"),
    )
    path = scratch_path(spark, "reports")
    reports.write.partitionBy("app_id", "report_type").options(
        header=True, escape='"', **TIME_FORMATS
    ).csv(path)
    schema = (
        "`Event ID` bigint, `Event Time` timestamp_ntz, `Event Name` string,"
        " `Customer User ID` bigint, `Event Value` double"
    )
    out = None
    for report_type in REPORT_TYPES:
        report = read_report_csv(
            spark,
            path,
            report_type,
            start=date(2024, 1, 2),
            end=date(2024, 1, 20),
            schema=schema,
        )
        out = report if out is None else out.unionByName(report)
    return out.select(
        "report_type",
        "app_id",
        "event_id",
        "event_time",
        "event_name",
        "customer_user_id",
        "event_value",
    )


def _app_id():
    """App ids with leading zeros."""
    number = (F.col("user_id") % 7).cast("string")
    return F.lpad(number, 3, "0").alias("app_id")


@query(
    "read_report_csv_inferred",
    """
    SELECT 'installs_report' AS report_type,
           lpad(CAST(user_id % 7 AS VARCHAR), 3, '0') AS app_id,
           event_id, 'c' || CAST(user_id % 5 AS VARCHAR) AS label, value
    FROM events WHERE event_type = 'signup'
    UNION ALL
    SELECT 'in_app_events_report',
           lpad(CAST(user_id % 7 AS VARCHAR), 3, '0'),
           event_id, event_type, value
    FROM events WHERE event_type <> 'signup'
    """,
)
def _read_report_csv_inferred(spark, sf_dir):
    """Types with headers of their own, read without a schema."""
    events = table(spark, sf_dir, "events")
    installs, in_app, _ = REPORT_TYPES
    path = scratch_path(spark, "reports")
    signup = F.col("event_type") == "signup"
    written = {
        installs: events.filter(signup).select(
            F.concat(F.lit("c"), F.col("user_id") % 5).alias("Campaign"),
            F.col("event_id").alias("Event ID"),
            F.col("value").alias("Event Value"),
            _app_id(),
        ),
        in_app: events.filter(~signup).select(
            F.col("event_id").alias("Event ID"),
            F.col("event_type").alias("Event Name"),
            F.col("value").alias("Event Value"),
            _app_id(),
        ),
    }
    for report_type, rows in written.items():
        rows.withColumn("report_type", F.lit(report_type)).write.partitionBy(
            "app_id", "report_type"
        ).mode("append").options(header=True, **TIME_FORMATS).csv(path)

    def read(report_type, label):
        return read_report_csv(spark, path, report_type).select(
            "report_type",
            "app_id",
            F.col("event_id").cast("bigint").alias("event_id"),
            F.col(label).alias("label"),
            F.col("event_value").alias("value"),
        )

    return read(installs, "campaign").unionByName(read(in_app, "event_name"))


def _pages(df, key, fields):
    """Payloads of up to 100 rows each, in the order of the key."""
    item = F.struct(*fields)
    return (
        batch_ids(df.select(*fields), PAGE_ITEMS, key, "page_no")
        .groupBy("page_no")
        .agg(F.array_sort(F.collect_list(item)).alias("results"))
        .select(
            F.lit("calls").alias("source"),
            F.when(
                F.col("page_no") > 0, F.col("page_no").cast("string")
            ).alias("token"),
            "page_no",
            F.to_json(
                F.struct(
                    "results",
                    F.struct(
                        F.struct(
                            (F.col("page_no") + 1)
                            .cast("string")
                            .alias("after")
                        ).alias("next")
                    ).alias("paging"),
                )
            ).alias("payload"),
        )
    )


@query(
    "read_pages",
    """
    SELECT CAST(n // 100 AS BIGINT) AS page_no, CAST(n % 100 AS INTEGER) AS pos,
           event_id, event_type, value
    FROM (SELECT event_id, event_type, value,
                 row_number() OVER (ORDER BY event_id) - 1 AS n
          FROM events)
    """,
)
def _read_pages(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    pages = _pages(events, "event_id", ["event_id", "event_type", "value"])
    return read_pages(
        pages,
        "after",
        "event_id bigint, event_type string, value double",
        keep=["page_no"],
    )


def _style_query(name: str, style: str, items: str, next_page):
    """Register the reading of pages of one continuation style."""

    @query(
        name,
        """
        SELECT page_no, CASE WHEN page_no < max(page_no) OVER ()
                 THEN CAST(page_no + 1 AS VARCHAR) END AS next_token,
               CAST(n % 100 AS INTEGER) AS pos, event_id, event_type
        FROM (SELECT CAST(n // 100 AS BIGINT) AS page_no, n, event_id, event_type
              FROM (SELECT event_id, event_type,
                           row_number() OVER (ORDER BY event_id) - 1 AS n
                    FROM events))
        """,
    )
    def _styled(spark, sf_dir):
        fields = ["event_id", "event_type"]
        events = table(spark, sf_dir, "events").select(*fields)
        pages = (
            batch_ids(events, PAGE_ITEMS, "event_id", "page_no")
            .groupBy("page_no")
            .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(items))
        )
        more = F.col("page_no") < (events.count() - 1) // PAGE_ITEMS
        token = F.when(more, (F.col("page_no") + 1).cast("string"))
        landed = pages.select(
            "page_no",
            F.to_json(F.struct(items, *next_page(token, more))).alias("payload"),
        )
        return read_pages(
            landed.withColumn("next_token", next_token("payload", style)),
            style,
            "event_id bigint, event_type string",
            keep=["page_no", "next_token"],
        )


_style_query(
    "read_pages_list_offset",
    "list_offset",
    "lists",
    lambda token, more: [token.alias("offset"), more.alias("has-more")],
)
_style_query(
    "read_pages_contact_offset",
    "contact_offset",
    "contacts",
    lambda token, more: [token.alias("vid-offset"), more.alias("has-more")],
)
_style_query(
    "read_pages_link",
    "link",
    "results",
    lambda token, _: [
        F.struct(F.struct(token.alias("link")).alias("next")).alias("paging")
    ],
)
_style_query(
    "read_pages_next_uri",
    "next_uri",
    "messages",
    lambda token, _: [F.coalesce(token, F.lit("")).alias("next_page_uri")],
)
_style_query(
    "read_pages_token",
    "token",
    "connections",
    lambda token, _: [token.alias("nextPageToken")],
)


@query(
    "missing_pages",
    """
    WITH landed AS (
      SELECT n // 100 AS page_no
      FROM (SELECT o_orderstatus,
                   row_number() OVER (ORDER BY o_orderkey) - 1 AS n
            FROM orders)
      GROUP BY 1
      HAVING count(*) FILTER (WHERE o_orderstatus = 'P') <= 36
    )
    SELECT 'calls' AS source, CAST(page_no + 1 AS VARCHAR) AS token
    FROM landed
    WHERE page_no + 1 NOT IN (SELECT page_no FROM landed)
    """,
)
def _missing_pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    pages = _pages(orders, "o_orderkey", ["o_orderkey", "o_orderstatus"])
    open_items = F.size(
        F.filter(
            F.from_json(
                F.get_json_object("payload", "$.results"),
                "array<struct<o_orderstatus:string>>",
            ),
            lambda item: item.getField("o_orderstatus") == "P",
        )
    )
    return missing_pages(pages.filter(open_items <= 36), "after")


@query(
    "run_sql",
    """
    SELECT o_orderpriority,
           count(*) AS lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
             AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderdate >= DATE '1997-01-01' AND l_returnflag = 'R'
    GROUP BY o_orderpriority
    """,
)
def _run_sql(spark, sf_dir):
    return run_sql(
        spark,
        """
        SELECT o_orderpriority,
               count(*) AS lines,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
                 AS price
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE o_orderdate >= :cutoff AND l_returnflag = :flag
        GROUP BY o_orderpriority
        """,
        {"cutoff": "1997-01-01", "flag": "R"},
        {
            "orders": table(spark, sf_dir, "orders"),
            "lineitem": table(spark, sf_dir, "lineitem"),
        },
    )


@query(
    "list_files",
    """
    SELECT 'o_orderstatus=' || o_orderstatus || '/year='
             || CAST(year(o_orderdate) AS VARCHAR) AS folder,
           'part' AS prefix, 'parquet' AS suffix, CAST(1 AS BIGINT) AS files,
           true AS has_bytes
    FROM orders GROUP BY o_orderstatus, year(o_orderdate)
    """,
)
def _list_files(spark, sf_dir):
    """One file in each folder of status and year, and no folder as a file."""
    path = scratch_path(spark, "listing")
    table(spark, sf_dir, "orders").withColumn(
        "year", F.year("o_orderdate")
    ).repartition("o_orderstatus", "year").write.partitionBy(
        "o_orderstatus", "year"
    ).parquet(path)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return (
        list_files(spark, path)
        .groupBy(
            F.concat_ws(
                "/", F.element_at(parts, -3), F.element_at(parts, -2)
            ).alias("folder"),
            F.substring_index(name, "-", 1).alias("prefix"),
            F.substring_index(name, ".", -1).alias("suffix"),
        )
        .agg(
            F.count("*").alias("files"),
            (F.min("length") > 0).alias("has_bytes"),
        )
    )


@query(
    "read_files_binary",
    "SELECT c_mktsegment AS segment, c_custkey, c_name FROM customer",
)
def _read_files_binary(spark, sf_dir):
    path = scratch_path(spark, "files")
    customer = table(spark, sf_dir, "customer")
    customer.select(
        "c_mktsegment", F.concat_ws(",", "c_custkey", "c_name").alias("value")
    ).write.partitionBy("c_mktsegment").option(
        "maxRecordsPerFile", DOCUMENT_ROWS
    ).text(path)
    files = read_files_binary(spark, path, glob="*.txt")
    text = F.rtrim(F.decode("content", "UTF-8"), F.lit("\n"))
    lines = files.select(
        F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1).alias("segment"),
        F.explode(F.split(text, "\n")).alias("line"),
    )
    parts = F.split("line", ",", 2)
    return lines.select(
        "segment",
        parts[0].cast("bigint").alias("c_custkey"),
        parts[1].alias("c_name"),
    )


@query(
    "grid_range",
    """
    SELECT c_name,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END
             AS c_mktsegment
    FROM customer
    """,
)
def _grid_range(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    full = F.array(
        F.col("c_custkey").cast("string"), F.col("c_name"), "c_mktsegment"
    )
    # Sheets leave out trailing empty cells, so rows are ragged.
    cells = F.when(
        F.col("c_mktsegment") == "BUILDING", F.slice(full, 1, 2)
    ).otherwise(full)
    rows = customer.select(
        (F.col("c_custkey") + 4).alias("row_idx"), cells.alias("cells")
    )
    header = spark.range(3, 4).select(
        F.col("id").alias("row_idx"),
        F.array(
            *[F.lit(n) for n in ("c_custkey", "c_name", "c_mktsegment")]
        ).alias("cells"),
    )
    return grid_range_frame(header.unionByName(rows), "Customers!B3:C")


@query(
    "table_info",
    """
    SELECT name, type, true AS nullable, position,
           (SELECT count(*) FROM orders) AS num_rows
    FROM (VALUES ('o_orderkey', 'bigint', 1), ('o_custkey', 'bigint', 2),
                 ('o_orderstatus', 'string', 3),
                 ('o_totalprice', 'double', 4),
                 ('o_orderdate', 'timestamp_ntz', 5),
                 ('o_orderpriority', 'string', 6)) t(name, type, position)
    """,
)
def _table_info(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return table_info(spark, "orders", count_rows=True)
