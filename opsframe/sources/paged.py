"""Landed response pages: their items, and the pages that are missing."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.lists import explode_once


class PageStyle(NamedTuple):
    """Where a payload keeps its items and the token of the next page."""

    items: str
    next_page: str
    more: str | None = None


# Field names of the five continuation styles.
PAGE_STYLES = {
    "list_offset": PageStyle("lists", "$['offset']", "$['has-more']"),
    "contact_offset": PageStyle(
        "contacts", "$['vid-offset']", "$['has-more']"
    ),
    "after": PageStyle("results", "$.paging.next.after"),
    "link": PageStyle("results", "$.paging.next.link"),
    "next_uri": PageStyle("messages", "$.next_page_uri"),
    "token": PageStyle("connections", "$.nextPageToken"),
}


def _style(style: str | PageStyle) -> PageStyle:
    if isinstance(style, PageStyle):
        return style
    if style not in PAGE_STYLES:
        raise ValueError(f"style must be one of {sorted(PAGE_STYLES)}")
    return PAGE_STYLES[style]


def read_pages(
    pages: DataFrame,
    style: str | PageStyle,
    item_schema: T.StructType | str,
    payload: str = "payload",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per item of every page: kept columns, ``pos``, the item's
    fields. A page without items gives none; a malformed page fails."""
    layout = _style(style)
    if isinstance(item_schema, T.DataType):
        item_schema = item_schema.simpleString()
    elif not item_schema.lower().startswith("struct<"):
        item_schema = f"struct<{item_schema}>"
    envelope = f"struct<`{layout.items}`:array<{item_schema}>>"
    parsed = F.from_json(payload, envelope, {"mode": "FAILFAST"})
    kept = list(keep or [])
    items = parsed.getField(layout.items)
    listed = explode_once(pages, items, "_item", kept, "pos")
    return listed.select(*kept, "pos", "_item.*")


def next_token(payload: Column | str, style: str | PageStyle) -> Column:
    """The token of the page that follows, NULL on the last page."""
    layout = _style(style)
    token = F.get_json_object(payload, layout.next_page)
    if layout.more is not None:
        more = F.get_json_object(payload, layout.more) == "true"
        return F.when(more, token)
    return F.when(token != "", token)


def missing_pages(
    pages: DataFrame,
    style: str | PageStyle,
    source: str = "source",
    token: str = "token",
    payload: str = "payload",
) -> DataFrame:
    """``(source, token)`` of pages that are referred to but not landed.

    ``token`` is the token a page was asked for with, NULL for a first page.
    """
    wanted = (
        pages.select(source, next_token(payload, style).alias(token))
        .filter(F.col(token).isNotNull())
        .distinct()
    )
    landed = pages.select(source, F.col(token).cast("string").alias(token))
    return wanted.join(landed, [source, token], "left_anti")


def check_pages(pages: DataFrame, style: str | PageStyle, **columns) -> DataFrame:
    """``pages``, or RuntimeError when a chain has a gap."""
    gap = missing_pages(pages, style, **columns).take(5)
    if gap:
        raise RuntimeError(f"pages not landed, among them {gap}")
    return pages
