"""Array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(
    df: DataFrame,
    array: Column | str,
    output: str,
    keep: list[str] | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per array element: kept columns, the element and, on request,
    its position.

    A plain ``explode`` makes Spark add a filter on the array's size, which
    computes a derived array, such as parsed JSON, a second time.
    """
    kept = list(keep or [])
    place = position or "_place"
    rows = df.select(
        *kept, F.posexplode_outer(array).alias(place, output)
    ).filter(F.col(place).isNotNull())
    return rows if position else rows.drop(place)


def flatten_lists(lists: Column | str) -> Column:
    """Join the sublists of an array of arrays, one level deep.

    A NULL sublist counts as empty; Spark's own ``flatten`` would make the
    whole result NULL.
    """
    column = F.col(lists) if isinstance(lists, str) else lists
    return F.flatten(F.filter(column, lambda part: part.isNotNull()))
