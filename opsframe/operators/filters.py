"""Predicates built from filter specifications.

Every comparison leaves the column bare and converts the literal, so that the
predicate reaches the file scan.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping
from datetime import date, datetime, time, timedelta, timezone
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPERATORS = {
    "EQ": operator.eq,
    "NEQ": operator.ne,
    "LT": operator.lt,
    "LTE": operator.le,
    "GT": operator.gt,
    "GTE": operator.ge,
}
_REQUIRED = ("propertyName", "operator", "value")
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def check_filters(filters: Any) -> None:
    """Raise ValueError unless ``filters`` is a list of complete filters."""
    if not isinstance(filters, list):
        raise ValueError("filters must be a list")
    for item in filters:
        if not isinstance(item, Mapping):
            raise ValueError(f"a filter must be a mapping: {item!r}")
        absent = [name for name in _REQUIRED if name not in item]
        if absent:
            raise ValueError(f"filter {item!r} lacks {absent}")
        for name in ("propertyName", "operator"):
            if not isinstance(item[name], str):
                raise ValueError(f"{name} must be a string: {item!r}")
        if item["operator"] not in _OPERATORS:
            raise ValueError(f"unknown operator {item['operator']!r}")


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.select(F.col(name)).schema[0].dataType


def _as_time(value: Any) -> Any:
    """Epoch milliseconds and zoned times as times in UTC; else unchanged."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        value = datetime(1970, 1, 1) + timedelta(milliseconds=float(value))
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def _literal(df: DataFrame, name: str, value: Any) -> Column:
    """``value`` as a literal of the column's type.

    Numbers against a timestamp column are epoch milliseconds.
    """
    dtype = _type_of(df, name)
    if isinstance(dtype, _TIMESTAMPS):
        value = _as_time(value)
        if isinstance(value, (date, datetime)):
            text = value.isoformat(" ") if isinstance(
                value, datetime
            ) else value.isoformat()
            return F.lit(text).cast(dtype)
        return F.lit(value).cast(dtype)
    numeric = isinstance(dtype, T.NumericType)
    if numeric and isinstance(value, (int, float, Decimal)):
        # Spark widens mixed numbers itself; a cast here could round 1.5 to 1.
        return F.lit(value)
    return F.lit(value).cast(dtype)


def _compare(df: DataFrame, name: str, how: str, value: Any) -> Column:
    """The comparison of a column with a value.

    A date column is compared with the time of day taken into account: dates
    are midnights, so a time inside a day is after that day's date.
    """
    column = F.col(name)
    if isinstance(_type_of(df, name), T.DateType):
        value = _as_time(value)
        if isinstance(value, datetime):
            day = F.lit(value.date())
            if value.time() == time():
                return _OPERATORS[how](column, day)
            if how in ("LT", "LTE"):
                return column <= day
            if how in ("GT", "GTE"):
                return column > day
            # No date is equal to it; a NULL still compares as NULL.
            return (column < day) & (column > day) if how == "EQ" else (
                (column == day) | (column != day)
            )
    return _OPERATORS[how](column, _literal(df, name, value))


def _condition(df: DataFrame, item: Mapping[str, Any]) -> Column:
    return _compare(df, item["propertyName"], item["operator"], item["value"])


def filter_groups(df: DataFrame, groups: list) -> DataFrame:
    """Rows that satisfy at least one group of ANDed filters.

    ``groups`` is a list of filters (one group) or a list of such lists. A
    filter is ``{"propertyName", "operator", "value"}``. No filters = all rows.
    """
    if groups and all(isinstance(g, list) for g in groups):
        nested = groups
    else:
        nested = [groups]
    for group in nested:
        check_filters(group)
    if not nested or any(not group for group in nested):
        return df
    every = [
        reduce(operator.and_, [_condition(df, item) for item in group])
        for group in nested
    ]
    return df.filter(reduce(operator.or_, every))


def since(
    df: DataFrame, column: str, after: datetime | date | int
) -> DataFrame:
    """Rows at or after a cutoff, given as a time or as epoch milliseconds."""
    return df.filter(_compare(df, column, "GTE", after))


def incremental_pull(
    df: DataFrame,
    column: str,
    after: datetime | date | int,
    key: str,
    seen: DataFrame | None = None,
    latest: bool = False,
) -> DataFrame:
    """``since`` without the rows pulled before.

    The cutoff is inclusive, so the rows on it come back with every pull;
    ``seen`` holds the key and time of the rows already taken. A row that was
    taken and has changed since has a later time and comes back. ``latest``
    keeps only the last row of each key; of rows tied on the last time the one
    with the largest hash of all its columns, so that every pull picks the
    same. A NULL key names no row: such rows are all kept.
    """
    fresh = since(df, column, after)
    if seen is not None:
        if column not in seen.columns:
            raise ValueError(f"seen must have the columns {key} and {column}")
        taken = [key, column]
        fresh = fresh.join(seen.select(*taken), taken, "left_anti")
    if latest:
        columns = [F.col(f"`{c}`") for c in df.columns]
        order = F.struct(F.col(column), F.xxhash64(*columns))
        named = fresh.filter(F.col(key).isNotNull())
        last = named.groupBy(F.col(key).alias("_key")).agg(
            F.max_by(F.struct(*columns), order).alias("_row")
        ).select("_row.*")
        fresh = last.unionByName(fresh.filter(F.col(key).isNull()))
    return fresh


def date_range(
    df: DataFrame, column: str, start: date, end: date
) -> DataFrame:
    """Rows from the start date through the end date, both included."""
    following = end + timedelta(days=1)
    return df.filter(
        (F.col(column) >= _literal(df, column, start))
        & (F.col(column) < _literal(df, column, following))
    )


def until(df: DataFrame, column: str, end: date) -> DataFrame:
    """Rows through the end date, included; the last date has no bound."""
    if end >= date.max:
        return df.filter(F.col(column).isNotNull())
    return df.filter(_compare(df, column, "LT", end + timedelta(days=1)))


def optional_filters(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality filters; an argument that is None or empty text adds none.

    A date against a timestamp column selects that whole day.
    """
    for name, value in wanted.items():
        if value is None or isinstance(value, str) and not value:
            continue
        dtype = df.schema[name].dataType
        whole_day = isinstance(value, date) and not isinstance(value, datetime)
        if isinstance(dtype, _TIMESTAMPS) and whole_day:
            df = date_range(df, name, value, value)
        else:
            df = df.filter(_compare(df, name, "EQ", value))
    return df
