"""Payloads of outgoing messages, message content and sparse updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import KEEP_NULLS, TIME_FORMATS
from opsframe.functions.text import form_encode, form_field
from opsframe.operators.validate import CONTENT_CATEGORIES

# Fixed value: the key of a content type is this prefix and its category.
CONTENT_PREFIX = "twilio/"


def message_requests(
    df: DataFrame,
    recipient: str = "recipient_phone",
    sender: str = "messaging_service_sid",
    body: str = "body",
    content: str = "content_sid",
    variables: str | None = "content_variables",
    keep: list[str] | None = None,
) -> DataFrame:
    """Outgoing messages -> ``To, From, Body, ContentSid, ContentVariables``
    and ``form``, the encoded request body.

    A missing body or content id is empty text. ``ContentVariables`` is JSON,
    NULL and left out of the form when there are no variables.
    """
    filled = F.lit(None).cast("string")
    if variables is not None and variables in df.columns:
        filled = F.when(
            F.size(variables) > 0, F.to_json(variables, KEEP_NULLS)
        )
    fields = {
        "To": F.col(recipient),
        "From": F.col(sender),
        "Body": F.coalesce(F.col(body), F.lit("")),
        "ContentSid": F.coalesce(F.col(content), F.lit("")),
        "ContentVariables": filled,
    }
    shaped = df.select(
        *(keep or []), *[c.alias(name) for name, c in fields.items()]
    )
    form = form_encode({name: F.col(name) for name in fields})
    return shaped.withColumn("form", form)


def content_payload(
    category: Column, body: Column, actions: Column, items: Column, button: Column
) -> Column:
    """The JSON payload of one content type; its fields depend on the
    category."""
    replies = F.struct(body.alias("body"), actions.alias("actions"))
    picker = F.struct(
        body.alias("body"), items.alias("items"), button.alias("button")
    )
    plain = F.struct(body.alias("body"))
    return (
        F.when(
            category.isin("quick-reply", "call-to-action"),
            F.to_json(replies, KEEP_NULLS),
        )
        .when(category == "list-picker", F.to_json(picker, KEEP_NULLS))
        .otherwise(F.to_json(plain, KEEP_NULLS))
    )


def content_types_map(
    df: DataFrame, request: str | list[str], seq: str
) -> DataFrame:
    """Content rows ``category, body, actions, items, button`` -> one row per
    request with ``types``, the JSON of category key -> payload.

    The later of two contents in one category wins. One partial aggregate per
    category keeps the state of a request at one payload each.
    """
    keys = [request] if isinstance(request, str) else list(request)
    category = F.col("category")
    payload = content_payload(
        category,
        F.col("body"),
        F.col("actions"),
        F.col("items"),
        F.col("button"),
    )
    shaped = df.select(*keys, seq, "category", payload.alias("_payload"))
    latest = [
        F.max_by(
            F.when(category == c, F.col("_payload")),
            F.when(category == c, F.col(seq)),
        ).alias(f"_type_{i}")
        for i, c in enumerate(CONTENT_CATEGORIES)
    ]
    unknown = F.max(
        F.when(
            ~F.coalesce(category.isin(CONTENT_CATEGORIES), F.lit(False)),
            F.coalesce(category, F.lit("null")),
        )
    )
    entries = [
        F.when(
            F.col(f"_type_{i}").isNotNull(),
            F.concat(F.lit(f'"{CONTENT_PREFIX}{c}":'), F.col(f"_type_{i}")),
        )
        for i, c in enumerate(CONTENT_CATEGORIES)
    ]
    # Payloads are JSON text already, so the object is put together as text.
    types = F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}"))
    known = F.when(F.col("_unknown").isNull(), types).otherwise(
        F.raise_error(F.concat(F.lit("unknown category: "), "_unknown"))
    )
    return (
        shaped.groupBy(*keys)
        .agg(*latest, unknown.alias("_unknown"))
        .select(*keys, known.alias("types"))
    )


def _kept(column: Column, dtype: T.DataType, drop: str) -> Column:
    """The value, or NULL where the update should leave it out."""
    if drop == "null":
        return column
    if isinstance(dtype, T.BooleanType):
        return F.when(column, column)
    if isinstance(dtype, T.NumericType):
        return F.when(column != 0, column)
    if isinstance(dtype, T.StringType):
        return F.when(column != "", column)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(column) > 0, column)
    return column


def sparse_record(
    df: DataFrame,
    key: str,
    fields: list[str] | None = None,
    drop: str = "falsy",
    rename=form_field,
    output: str = "record",
    mode: str = "raise",
):
    """Add ``record``, the JSON of an update without its unset fields.

    ``drop`` leaves out ``falsy`` values (NULL, false, 0, empty) or only
    ``null``; the key stays whatever its value. An update that holds nothing but its key fails the query, or
    with ``mode="split"`` comes back in a second frame:
    ``(records, rejected rows)``.
    """
    if drop not in ("falsy", "null"):
        raise ValueError("drop must be falsy or null")
    if mode not in ("raise", "split"):
        raise ValueError("mode must be raise or split")
    others = [c for c in (fields or df.columns) if c != key]
    # The key says which record is meant and stays, even when it is 0.
    kept = {key: F.col(key)} | {
        name: _kept(F.col(name), df.schema[name].dataType, drop)
        for name in others
    }
    named = F.struct(*[c.alias(rename(n)) for n, c in kept.items()])
    record = F.to_json(named, TIME_FORMATS)
    bare = F.lit(True)
    for name in others:
        bare = bare & kept[name].isNull()
    shaped = df.withColumn(output, record)
    if mode == "split":
        return shaped.filter(~bare), df.filter(bare)
    complaint = F.lit(f"one of these values is required: {others}")
    return shaped.filter(
        F.when(~bare, F.lit(True)).otherwise(
            F.raise_error(complaint).cast("boolean")
        )
    )
