"""Writing a table's cells into a spreadsheet grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.operators.batching import index_rows
from opsframe.sources.grid import column_letters, parse_range


def _start(range_start: str):
    if "!" not in range_start:
        raise ValueError("range_start needs a '!' after the sheet name")
    return parse_range(range_start)


def updated_range(range_start: str, columns: int, rows: int) -> str:
    """The A1 range that a table of this size fills from ``range_start``."""
    area = _start(range_start)
    first, last = area.first_col, area.first_col + columns - 1
    bottom = area.first_row + rows - 1
    return (
        f"{area.sheet}!{column_letters(first)}{area.first_row}"
        f":{column_letters(last)}{bottom}"
    )


def grid_update(
    grid: DataFrame,
    range_start: str,
    df: DataFrame,
    order_by: str | list,
) -> DataFrame:
    """The grid with the values of ``df`` written from ``Sheet!B3`` on, in the
    given order and without a header. A NULL value leaves its cell alone."""
    area = _start(range_start)
    left, width = area.first_col, len(df.columns)
    values = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    indexed = index_rows(df, order_by, "_index")
    written = indexed.select(
        (F.col("_index") + area.first_row).cast("int").alias("row_idx"),
        values.alias("_values"),
    )
    old, new = F.col("cells"), F.col("_values")
    held = F.coalesce(F.size(old), F.lit(0))

    def cell(i: Column) -> Column:
        before = F.get(old, i)
        inside = (i >= left) & (i < left + width)
        return F.when(
            inside, F.coalesce(F.get(new, i - left), before)
        ).otherwise(before)

    places = F.sequence(F.lit(0), F.greatest(held, F.lit(left + width)) - 1)
    merged = F.when(new.isNull(), old).otherwise(F.transform(places, cell))
    return grid.join(written, "row_idx", "full").select(
        "row_idx", merged.alias("cells")
    )
