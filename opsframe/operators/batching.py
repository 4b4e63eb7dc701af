"""Exact row indexes and batch numbers without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.session import scratch_path

_PART, _POS = "_part", "_pos"
# monotonically_increasing_id() holds the row's position in the low 33 bits.
_POS_BITS = 33


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` range-sorted over its partitions and written to the scratch
    folder with each row's partition number and position.

    Written, not cached or planned twice: Spark draws the ranges anew for each
    plan, so the count per range and the rows must come from one run, also
    after an executor is lost. Rows tied on ``order`` follow each other in
    input order and are spread by it, so neither a frequent value nor copies
    of one row fill a task.
    """
    keys = [*order, F.monotonically_increasing_id()]
    row_id = F.monotonically_increasing_id()
    path = scratch_path(df.sparkSession, "ranged")
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", row_id)
        .withColumn(_PART, F.shiftright("_id", _POS_BITS))
        .withColumn(_POS, F.col("_id").bitwiseAND((1 << _POS_BITS) - 1))
        .drop("_id")
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def index_rows(
    df: DataFrame,
    order_by: str | list,
    output: str = "row_idx",
    within: list[str] | None = None,
) -> DataFrame:
    """Add each row's 0-based position in the order, over all rows or inside
    every group of ``within``.

    ``order_by`` should be unique (inside a group); ties keep their input
    order. Without ``within`` the only window runs over one row per written
    partition, in one task; inside groups it runs over the pieces of a group.
    """
    order = [order_by] if isinstance(order_by, (str, Column)) else order_by
    groups = list(within or [])
    ranged = _ranged(df, [*groups, *order])
    first_of = [*groups, _PART]
    pieces = ranged.groupBy(*first_of).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first")
    )
    before = Window.orderBy(_PART).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    if groups:
        # At most one piece per group and partition: a hot group is spread
        # over many pieces, a window frame holds one group's pieces only.
        before = before.partitionBy(*groups)
    offsets = pieces.select(
        *first_of,
        (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias(
            "_shift"
        ),
    )
    if not groups:
        # One row per written partition, which bounds its size.
        offsets = F.broadcast(offsets)
    matches = [F.col(f"r.{_PART}") == F.col(f"o.{_PART}")] + [
        F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in groups
    ]
    joined = ranged.alias("r").join(offsets.alias("o"), matches)
    return joined.select(
        *[F.col(f"r.`{c}`") for c in df.columns],
        (F.col(f"r.{_POS}") + F.col("o._shift")).alias(output),
    )


def batch_ids(
    df: DataFrame,
    size: int,
    order_by: str | list,
    output: str = "batch",
    within: list[str] | None = None,
) -> DataFrame:
    """Number the successive batches of ``size`` rows; the last may be short."""
    if size < 1:
        raise ValueError("batch size must be positive")
    indexed = index_rows(df, order_by, "_index", within)
    number = F.call_function("div", F.col("_index"), F.lit(size))
    return indexed.withColumn(output, number).drop("_index")
