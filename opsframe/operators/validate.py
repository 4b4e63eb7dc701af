"""Row validation: each rule is a condition and the reason for failing it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The content categories that exist.
CONTENT_CATEGORIES = [
    "text",
    "media",
    "location",
    "list-picker",
    "quick-reply",
    "call-to-action",
    "card",
]
PAGE_SIZE_LIMIT = 100


class Rule(NamedTuple):
    reason: str
    broken: Column


def _blank(column: Column) -> Column:
    return column.isNull() | (column.cast("string") == "")


def _empty(column: Column) -> Column:
    return column.isNull() | (F.size(column) == 0)


def contact_rules(df: DataFrame) -> list[Rule]:
    """A contact has an email or a vid, and properties that each name a
    property and hold a string, boolean or integer."""
    items = F.col("properties")
    value_type = df.schema["properties"].dataType.elementType["value"].dataType
    return [
        Rule(
            "email or vid is required",
            _blank(F.col("vid")) & _blank(F.col("email")),
        ),
        Rule("properties is required", items.isNull()),
        Rule(
            "property is required",
            F.exists(items, lambda p: p.getField("property").isNull()),
        ),
        Rule(
            "value is required",
            F.exists(items, lambda p: p.getField("value").isNull()),
        ),
        Rule("value has a wrong type", _wrong_value(items, value_type)),
    ]


def _wrong_value(items: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.VariantType):
        allowed = ["STRING", "BOOLEAN", "BIGINT"]
        return F.exists(
            items,
            lambda p: p.getField("value").isNotNull()
            & ~F.schema_of_variant(p.getField("value")).isin(allowed),
        )
    fits = isinstance(
        dtype, (T.StringType, T.BooleanType, T.IntegerType, T.LongType)
    )
    if fits:
        return F.lit(False)
    return F.exists(items, lambda p: p.getField("value").isNotNull())


def _checked_items(items: Column, every: bool) -> Column:
    """The list elements that a rule looks at: the first, or all."""
    return items if every else F.slice(items, 1, 1)


def person_rules(every: bool = False) -> list[Rule]:
    """A person has names with a given name, and phone numbers, when given,
    with a value. Only the first element of a list is checked unless
    ``every``."""
    names = _checked_items(F.col("names"), every)
    phones = _checked_items(F.col("phoneNumbers"), every)
    return [
        Rule("names is required", F.col("names").isNull()),
        Rule(
            "names.givenName is required",
            F.exists(names, lambda n: n.getField("givenName").isNull()),
        ),
        Rule(
            "phoneNumbers.value is required",
            F.exists(phones, lambda p: p.getField("value").isNull()),
        ),
    ]


def person_batch_rules(every: bool = False) -> list[Rule]:
    """A batch holds contacts whose person has names with a given name."""
    contacts = _checked_items(F.col("contacts"), every)

    def person(contact: Column) -> Column:
        return contact.getField("contactPerson")

    def nameless(contact: Column) -> Column:
        names = _checked_items(person(contact).getField("names"), every)
        return F.coalesce(
            F.exists(names, lambda n: n.getField("givenName").isNull()),
            F.lit(False),
        )

    return [
        Rule("contacts is required", F.col("contacts").isNull()),
        Rule(
            "contactPerson is required",
            F.exists(contacts, lambda c: person(c).isNull()),
        ),
        Rule(
            "contactPerson.names is required",
            F.exists(
                contacts,
                lambda c: person(c).isNotNull()
                & person(c).getField("names").isNull(),
            ),
        ),
        Rule(
            "names.givenName is required", F.exists(contacts, nameless)
        ),
    ]


def content_rules() -> list[Rule]:
    """Message content: a known category, a body, and what the category
    needs besides."""
    category = F.col("category")
    return [
        Rule(
            "unknown category",
            ~F.coalesce(category.isin(CONTENT_CATEGORIES), F.lit(False)),
        ),
        Rule("body is required", F.col("body").isNull()),
        Rule(
            "list-picker needs items",
            (category == "list-picker") & _empty(F.col("items")),
        ),
        Rule(
            "list-picker needs button",
            (category == "list-picker") & _blank(F.col("button")),
        ),
        Rule(
            "reply needs actions",
            category.isin("quick-reply", "call-to-action")
            & _empty(F.col("actions")),
        ),
    ]


def check_page_size(count: int) -> int:
    """Raise ValueError for a page size over the limit."""
    if count > PAGE_SIZE_LIMIT:
        raise ValueError(f"at most {PAGE_SIZE_LIMIT} items per page")
    return count


def tag_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reasons``, the list of broken rules, empty for a valid row."""
    marks = F.array(*[F.when(r.broken, F.lit(r.reason)) for r in rules])
    return df.withColumn(
        "reasons", F.filter(marks, lambda reason: reason.isNotNull())
    )


def validate_rows(
    df: DataFrame, rules: list[Rule], mode: str = "split"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """``split``: ``(valid rows, rejected rows with reasons)``; ``raise``: the
    rows, with a query that fails on the first bad one."""
    tagged = tag_rows(df, rules)
    bad = F.size("reasons") > 0
    if mode == "split":
        return tagged.filter(~bad).drop("reasons"), tagged.filter(bad)
    if mode != "raise":
        raise ValueError("mode must be split or raise")
    complaint = F.concat(F.lit("invalid row: "), F.array_join("reasons", "; "))
    checked = F.when(~bad, F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    return tagged.filter(checked).drop("reasons")
