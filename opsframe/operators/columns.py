"""Column renaming and projection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.functions.text import form_field


def _rename(df: DataFrame, names: list[str]) -> DataFrame:
    repeated = [name for name, n in Counter(names).items() if n > 1]
    if repeated:
        raise ValueError(f"column names collide after renaming: {repeated}")
    return df.toDF(*names)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case the column names and put ``_`` for each space."""
    return _rename(df, [c.lower().replace(" ", "_") for c in df.columns])


def pascal_columns(df: DataFrame) -> DataFrame:
    """``friendly_name`` -> ``FriendlyName`` for every column."""
    return _rename(df, [form_field(c) for c in df.columns])


def select_properties(
    df: DataFrame, properties: Iterable[str] | None, always: Iterable[str] = ()
) -> DataFrame:
    """Keep the named columns; ``always`` come first. No properties = all.

    A dotted name picks a nested field and is named after its last part.
    """
    if not properties:
        return df
    keep = list(dict.fromkeys([*always, *properties]))
    return df.select(*[F.col(name) for name in keep])
