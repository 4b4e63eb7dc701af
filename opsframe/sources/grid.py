"""Spreadsheet grids: one row ``row_idx INT, cells ARRAY<STRING>`` per sheet
row, numbered from 1 as in A1 notation. A grid holds one sheet."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CELL = re.compile(r"^([A-Za-z]*)([0-9]*)$")


class GridRange(NamedTuple):
    """Bounds of a range, columns from 0 and rows from 1; None is open."""

    sheet: str | None
    first_col: int = 0
    first_row: int = 1
    last_col: int | None = None
    last_row: int | None = None


def column_index(letters: str) -> int:
    """``A`` -> 0, ``Z`` -> 25, ``AA`` -> 26."""
    if not re.fullmatch(r"[A-Za-z]+", letters):
        raise ValueError(f"no column letters: {letters!r}")
    number = 0
    for letter in letters.upper():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def column_letters(index: int) -> str:
    """0 -> ``A``, 25 -> ``Z``, 26 -> ``AA``."""
    letters = ""
    number = index + 1
    while number > 0:
        number, rest = divmod(number - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def _cell(text: str) -> tuple[int | None, int | None]:
    match = _CELL.match(text)
    if not match or not text:
        raise ValueError(f"no cell reference: {text!r}")
    letters, digits = match.groups()
    return (
        column_index(letters) if letters else None,
        int(digits) if digits else None,
    )


def parse_range(text: str) -> GridRange:
    """``Sheet!A1:D2``, ``Sheet!B3``, ``Sheet!A:C`` or a sheet name alone."""
    sheet, mark, cells = text.rpartition("!")
    if not mark:
        if ":" not in text:
            return GridRange(text)
        sheet, cells = None, text
    start, colon, end = cells.partition(":")
    first_col, first_row = _cell(start)
    last_col, last_row = _cell(end) if colon else (first_col, first_row)
    return GridRange(
        sheet, first_col or 0, first_row or 1, last_col, last_row
    )


def grid_range(grid: DataFrame, sheet_range: str) -> DataFrame:
    """The rows and cells of a range, as a grid with the same row numbers."""
    area = parse_range(sheet_range)
    rows = grid.filter(F.col("row_idx") >= area.first_row)
    if area.last_row is not None:
        rows = rows.filter(F.col("row_idx") <= area.last_row)
    if area.last_col is None:
        width = F.greatest(F.size("cells") - area.first_col, F.lit(0))
    else:
        width = F.lit(area.last_col - area.first_col + 1)
    cells = F.slice("cells", F.lit(area.first_col + 1), width)
    return rows.select("row_idx", cells.alias("cells"))


def grid_range_frame(
    grid: DataFrame,
    sheet_range: str,
    header_row: int = 0,
    keep_index: bool = False,
) -> DataFrame:
    """A range as a table: the cells of row ``header_row`` (from 0) name the
    columns, the rows below it are the data.

    A short row is filled with NULL, a row longer than the header fails the
    query, and a range without rows from the header on is an error.
    """
    area = grid_range(grid, sheet_range)
    at = parse_range(sheet_range).first_row + header_row
    header = area.filter(F.col("row_idx") == at).take(1)
    if not header:
        raise ValueError("the range has no data")
    names = header[0].cells
    too_long = F.raise_error(
        F.concat(F.lit("row longer than the header: "), F.col("row_idx"))
    ).cast("boolean")
    data = area.filter(F.col("row_idx") > at).filter(
        F.when(F.size("cells") <= len(names), F.lit(True)).otherwise(too_long)
    )
    index = ["row_idx"] if keep_index else []
    return data.select(
        *index,
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)],
    )
