"""Flattening and searching of nested records.

Each record is walked inside its own row: the walker builds one array of
``(path, value)`` nodes, which ``node_map`` explodes and ``find_paths``
filters. Nothing is shuffled. Values are JSON text, so that a number, a string
and a list stay apart in one column.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.json_text import as_json_text

_NODES = "array<struct<path:string,value:string>>"


class _Walk(NamedTuple):
    """How a typed record is walked."""

    lists: str
    nulls: str
    # Makes one node from its path and its JSON text.
    make: Callable[[Column, Column], Column]
    empty: Column
    # The only path to visit, if not all.
    wanted: str | None = None

    def node(self, path: str | Column, text: Column) -> Column:
        literal = F.lit(path) if isinstance(path, str) else path
        return self.make(literal, text)

    def visits(self, path: str | Column, inside: bool = False) -> bool:
        """Whether the path, or one inside it, is wanted."""
        if self.wanted is None or not isinstance(path, str):
            return True
        return self.wanted == path or (
            inside and self.wanted.startswith(f"{path}.")
        )


def _child(path: str | Column | None, key: str | Column) -> str | Column:
    if path is None:
        return key
    if isinstance(path, str) and isinstance(key, str):
        return f"{path}.{key}"
    start = F.lit(path) if isinstance(path, str) else path
    end = F.lit(key) if isinstance(key, str) else key
    return F.concat(start, F.lit("."), end)


def _typed_nodes(
    column: Column,
    dtype: T.DataType,
    path: str | Column | None,
    walk: _Walk,
    held: Column | None = None,
) -> tuple[list[Column], list[Column]]:
    """The single nodes and the arrays of nodes under ``column``.

    A single node is NULL where there is nothing to emit, an array is not.
    ``held`` says that all enclosing dicts exist; it matters only when NULLs
    are emitted, as a NULL dict is one node and its fields are none.
    """
    emits = walk.nulls == "emit"

    if isinstance(dtype, T.StructType):
        singles, arrays = [], []
        inside = held
        if emits and path is not None:
            exists = column.isNotNull()
            inside = exists if held is None else held & exists
            gone = ~exists if held is None else held & ~exists
            if walk.visits(path):
                singles.append(F.when(gone, walk.node(path, F.lit("null"))))
        for field in dtype.fields:
            below = _child(path, field.name)
            if not walk.visits(below, inside=True):
                continue
            more_singles, more_arrays = _typed_nodes(
                column.getField(field.name), field.dataType, below, walk, inside
            )
            singles += more_singles
            arrays += more_arrays
        return singles, arrays

    if path is None and not isinstance(dtype, T.MapType):
        return [], []
    gone = column.isNull() if held is None else held & column.isNull()
    null_node = []
    if emits and path is not None and walk.visits(path):
        null_node = [F.when(gone, walk.node(path, F.lit("null")))]

    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: _assemble(
                _typed_nodes(
                    e.getField("value"),
                    dtype.valueType,
                    _child(path, e.getField("key").cast("string")),
                    walk,
                ),
                walk,
            ),
        )
        return null_node, [F.coalesce(F.flatten(entries), walk.empty)]

    text = as_json_text(column, dtype)
    if not isinstance(dtype, T.ArrayType) or walk.lists == "leaf":
        if not walk.visits(path):
            return [], []
        if emits:
            node = walk.node(path, text)
            return [node if held is None else F.when(held, node)], []
        return [F.when(column.isNotNull(), walk.node(path, text))], []

    element = dtype.elementType

    def plain(item: Column) -> Column:
        shown = text if walk.lists == "whole" else as_json_text(item, element)
        return walk.node(path, shown)

    if isinstance(element, (T.StructType, T.MapType)):
        nodes_of = F.flatten(
            F.transform(
                column,
                lambda item: F.when(
                    item.isNull(),
                    F.array(plain(item)) if walk.visits(path) else walk.empty,
                ).otherwise(
                    _assemble(_typed_nodes(item, element, path, walk), walk)
                ),
            )
        )
    elif not walk.visits(path):
        return [], []
    elif walk.lists == "whole":
        nodes_of = F.array_repeat(walk.node(path, text), F.size(column))
    else:
        nodes_of = F.transform(column, plain)
    return null_node, [F.coalesce(nodes_of, walk.empty)]


def _assemble(
    found: tuple[list[Column], list[Column]], walk: _Walk
) -> Column:
    """One array of nodes; it may hold NULLs."""
    singles, arrays = found
    parts = [*([F.array(*singles)] if singles else []), *arrays]
    if not parts:
        return walk.empty
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _no_nodes() -> Column:
    return F.array().cast(_NODES)


def _full_node(path: Column, text: Column) -> Column:
    return F.struct(path.alias("path"), text.alias("value"))


def _has_maps(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_maps(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_maps(f.dataType) for f in dtype.fields)
    return False


def _open(path: Column, value: Column, leaf: bool) -> Column:
    return F.struct(
        path.alias("path"), value.alias("value"), F.lit(leaf).alias("leaf")
    )


def _entries(path: Column, value: Column, first: bool = False) -> Column:
    """The open nodes of a dict's entries; NULL when the value is no dict."""

    def node(entry: Column) -> Column:
        key = entry.getField("key")
        below = key if first else F.concat(path, F.lit("."), key)
        return _open(below, entry.getField("value"), False)

    dicts = F.try_variant_get(value, "$", "map<string,variant>")
    return F.transform(F.map_entries(dicts), node)


def _items(path: Column, value: Column, lists: str) -> Column:
    """The nodes of a list's items; NULL when the value is no list."""
    items = F.try_variant_get(value, "$", "array<variant>")
    if lists == "leaf":
        return F.when(items.isNotNull(), F.array(_open(path, value, True)))

    def nodes_of(item: Column) -> Column:
        shown = value if lists == "whole" else item
        return F.coalesce(
            _entries(path, item), F.array(_open(path, shown, True))
        )

    return F.flatten(F.transform(items, nodes_of))


def _expand(node: Column, lists: str) -> Column:
    """The nodes one dict level below an open node; a leaf stays as it is."""
    path, value = node.getField("path"), node.getField("value")
    return F.when(node.getField("leaf"), F.array(node)).otherwise(
        F.coalesce(
            _entries(path, value),
            _items(path, value, lists),
            F.array(_open(path, value, True)),
        )
    )


def variant_depth(df: DataFrame, column: str) -> int:
    """How deep brackets are nested in the VARIANT values of a column: one
    aggregate over it, of which a single number comes to the driver.

    Strings are cut out of the JSON text without recursion: first every
    escaped character, then every run between two quotes. Neither pattern
    repeats a group, so a string of any length costs one linear scan. Of the
    brackets left, each shape is measured once.
    """
    text = F.to_json(column)
    unescaped = F.when(
        F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")
    ).otherwise(text)
    # Runs of other characters go first: what is left is short.
    marks = F.regexp_replace(unescaped, r'[^\[\]{}"]+', "")
    shape = F.regexp_replace(marks, r'"[^"]*"', "")
    brackets = F.split("shape", "")
    state = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(held: Column, sign: Column) -> Column:
        now = held["now"] + (
            F.when(sign.isin("{", "["), 1).when(sign.isin("}", "]"), -1)
            .otherwise(0)
        )
        return F.struct(
            now.alias("now"), F.greatest(held["most"], now).alias("most")
        )

    deepest = F.aggregate(brackets, state, step)["most"]
    shapes = df.select(shape.alias("shape")).distinct()
    return shapes.agg(F.max(deepest)).first()[0] or 0


# Columns of the row walk; the caller's columns keep their own names.
_P, _V, _J = "__walk_path", "__walk_open", "__walk_json"


def _exploded(rows: DataFrame, value: Column, tag: str) -> DataFrame:
    """``rows`` laterally joined with the entries or items of ``value``: one
    row per entry (key set) or item (key NULL), one row of NULLs for a scalar,
    an empty container or a NULL."""
    found = rows.sparkSession.tvf.variant_explode_outer(value.outer())
    return rows.lateralJoin(found.toDF(f"{tag}pos", f"{tag}key", f"{tag}val"))


def _below(path: Column, key: Column) -> Column:
    return F.concat(path, F.lit("."), key)


def _walk_level(rows: DataFrame, kept: list[str], lists: str) -> DataFrame:
    """One level of the frontier: every open node is exploded once; closed
    nodes pass through a NULL and stay as they are."""
    first = _exploded(rows, F.col(_V), "__a_")
    pos, key, child = F.col("__a_pos"), F.col("__a_key"), F.col("__a_val")
    is_open = F.col(_V).isNotNull()
    is_list = is_open & pos.isNotNull() & key.isNull()
    items = first.withColumn(
        "__item", F.when(is_list & F.lit(lists != "leaf"), child)
    )
    second = _exploded(items, F.col("__item"), "__b_")
    pos2, key2, grandchild = (
        F.col("__b_pos"), F.col("__b_key"), F.col("__b_val")
    )
    path, value = F.col(_P), F.col(_V)
    shown = F.to_json(value) if lists == "whole" else F.to_json(child)
    lone = F.to_json(value)
    item = F.to_json(child)
    # (keep, path, open value, closed JSON) in the order the cases are tried.
    cases = [
        (~is_open, path, F.lit(None), F.col(_J)),
        (key.isNotNull(), _below(path, key), child, F.lit(None)),
        (
            is_list & F.lit(lists == "leaf") & (pos == 0),
            path, F.lit(None), lone,
        ),
        (is_list & F.lit(lists == "leaf"), None, None, None),
        (is_list & key2.isNotNull(), _below(path, key2), grandchild, F.lit(None)),
        (is_list & pos2.isNotNull() & (pos2 == 0), path, F.lit(None), shown),
        (is_list & pos2.isNotNull(), None, None, None),
        (is_list & (item == "{}"), None, None, None),
        (is_list, path, F.lit(None), shown),
        (lone.isin("{}" if lists == "leaf" else ["{}", "[]"]), None, None, None),
        (F.lit(True), path, F.lit(None), lone),
    ]

    # One CASE of arrays with one node or none, so that a value's JSON text is
    # not made again for each column and for the filter.
    picked = None
    for holds, *got in cases:
        node = F.lit(None) if got[0] is None else F.array(F.struct(
            got[0].alias(_P),
            got[1].cast("variant").alias(_V),
            got[2].cast("string").alias(_J),
        ))
        picked = (F if picked is None else picked).when(holds, node)
    return second.select(*kept, F.inline(picked))


def _variant_rows(
    df: DataFrame, column: str, kept: list[str], lists: str, depth: int
) -> DataFrame:
    """``(kept..., path, value)`` for every leaf, walked as rows.

    The frontier is a set of rows: the entries of the record first, then at
    each level the entries or items of open nodes only, by the lateral
    ``variant_explode_outer``. Items of a list are looked into at the same
    level, so that a dict in a list opens its entries under the list's path
    and anything else closes. All levels stay in one stage; nothing is
    shuffled. A node still open after ``depth`` levels fails the query.
    """
    top = _exploded(df.select(*kept, F.col(column).alias("__rec")),
                    F.col("__rec"), "__t_")
    rows = top.where(F.col("__t_key").isNotNull()).select(
        *kept,
        F.col("__t_key").alias(_P),
        F.col("__t_val").alias(_V),
        F.lit(None).cast("string").alias(_J),
    )
    for _ in range(depth):
        rows = _walk_level(rows, kept, lists)
    deeper = F.raise_error(
        F.lit(f"dicts are nested deeper than max_depth={depth}")
    ).cast("string")
    return rows.select(
        *kept,
        F.col(_P).alias("path"),
        F.when(F.col(_V).isNull(), F.col(_J)).otherwise(deeper).alias("value"),
    )


def _next_level(found: Column, lists: str) -> Column:
    return F.flatten(F.transform(found, lambda node: _expand(node, lists)))


def _variant_nodes(column: Column, max_depth: int, lists: str) -> Column:
    found = _entries(F.lit(""), column, first=True)
    for _ in range(max_depth):
        found = _next_level(found, lists)
    return _closed(found, max_depth)


def _with_nodes(
    df: DataFrame,
    column: str,
    output: str,
    lists: str,
    nulls: str,
    max_depth: int | None,
) -> DataFrame:
    """``df`` with the nodes of a record as a column, NULLs between them.

    The levels of a VARIANT record are columns one after the other: as one
    expression, deep records would take the analyzer too many rounds.
    """
    dtype = df.select(F.col(column)).schema[0].dataType
    if not isinstance(dtype, T.VariantType):
        found = _raw_nodes(df, column, lists, nulls, max_depth)
        return df.withColumn(output, found)
    _check(lists, nulls)
    depth = variant_depth(df, column) if max_depth is None else max_depth
    df = df.withColumn(output, _entries(F.lit(""), F.col(column), first=True))
    for _ in range(depth):
        df = df.withColumn(output, _next_level(F.col(output), lists))
    return df.withColumn(output, _closed(F.col(output), depth))


def _closed(found: Column, max_depth: int) -> Column:
    """The nodes of a record when none is open any more."""
    # A node still open is an entry of a dict one level too deep.
    deeper = F.raise_error(
        F.lit(f"dicts are nested deeper than max_depth={max_depth}")
    ).cast("string")
    closed = F.transform(
        found,
        lambda node: _full_node(
            node.getField("path"),
            F.when(
                node.getField("leaf"), F.to_json(node.getField("value"))
            ).otherwise(deeper),
        ),
    )
    return F.coalesce(closed, _no_nodes())


def _check(lists: str, nulls: str) -> None:
    if lists not in ("whole", "element", "leaf"):
        raise ValueError("lists must be whole, element or leaf")
    if nulls not in ("drop", "emit"):
        raise ValueError("nulls must be drop or emit")


def _raw_nodes(
    df: DataFrame, column: str, lists: str, nulls: str, max_depth: int | None
) -> Column:
    """The nodes of a record, NULLs between them in the typed plan."""
    _check(lists, nulls)
    dtype = df.select(F.col(column)).schema[0].dataType
    if isinstance(dtype, T.VariantType):
        depth = variant_depth(df, column) if max_depth is None else max_depth
        return _variant_nodes(F.col(column), depth, lists)
    walk = _Walk(lists, nulls, _full_node, _no_nodes())
    found = _typed_nodes(F.col(column), dtype, None, walk)
    return F.when(F.col(column).isNotNull(), _assemble(found, walk)).otherwise(
        _no_nodes()
    )


def nodes(
    df: DataFrame,
    column: str,
    lists: str = "whole",
    nulls: str = "drop",
    max_depth: int | None = None,
) -> Column:
    """The ``array<struct<path, value>>`` of every leaf under ``column``.

    ``lists`` says what an element that is no dict gives: ``whole`` the entire
    list once per element, ``element`` the element alone, ``leaf`` the list
    once without descending into it. Dicts inside a list keep the list's path.

    A typed column cannot tell an absent key from ``null``: ``nulls`` drops
    them or emits ``null``. A VARIANT column is exact. Its depth is taken from
    the data by a pass over the column; ``max_depth`` gives it beforehand, as a
    stream needs it, and a deeper record then fails the query.
    """
    return F.array_compact(_raw_nodes(df, column, lists, nulls, max_depth))


def node_map(
    df: DataFrame,
    column: str,
    keys: list[str] | None = None,
    lists: str = "whole",
    nulls: str = "drop",
    max_depth: int | None = None,
) -> DataFrame:
    """One row ``(keys..., path, value)`` per leaf of the nested record; see
    ``nodes`` for the options."""
    kept = [c for c in df.columns if c != column] if keys is None else keys
    dtype = df.select(F.col(column)).schema[0].dataType
    if isinstance(dtype, T.VariantType):
        _check(lists, nulls)
        depth = variant_depth(df, column) if max_depth is None else max_depth
        return _variant_rows(df, column, kept, lists, depth)
    walked = _with_nodes(
        df.select(*dict.fromkeys([*kept, column])),
        column,
        "_nodes",
        lists,
        nulls,
        max_depth,
    )
    exploded = walked.select(*kept, F.explode("_nodes").alias("_node"))
    return exploded.filter(F.col("_node").isNotNull()).select(
        *kept, "_node.path", "_node.value"
    )


def leaf_paths(
    df: DataFrame, column: str, output: str = "paths", max_depth: int | None = None
) -> DataFrame:
    """Add the dotted paths of all leaves. Lists are leaves, an empty dict
    gives none."""
    dtype = df.select(F.col(column)).schema[0].dataType
    if isinstance(dtype, T.VariantType):
        walked = _with_nodes(df, column, "_nodes", "leaf", "drop", max_depth)
        found = F.transform("_nodes", lambda node: node.getField("path"))
        return walked.withColumn(output, found).drop("_nodes")
    walk = _Walk(
        "leaf", "drop", lambda path, _: path, F.array().cast("array<string>")
    )
    names = _assemble(_typed_nodes(F.col(column), dtype, None, walk), walk)
    return df.withColumn(output, F.array_compact(names))


def _typed_values(
    column: Column, dtype: T.DataType, path: str, lists: str, nulls: str
) -> tuple[Column, bool]:
    """The values at one path of a record without maps, and whether they are
    an array: a path that meets no list has at most one value."""
    walk = _Walk(
        lists,
        nulls,
        lambda _, text: text,
        F.array().cast("array<string>"),
        path,
    )
    singles, arrays = _typed_nodes(column, dtype, None, walk)
    if len(singles) == 1 and not arrays:
        return singles[0], False
    return F.array_compact(_assemble((singles, arrays), walk)), True


def _values_of(found: str, path: str) -> Column:
    hits = F.filter(found, lambda node: node.getField("path") == path)
    return F.transform(hits, lambda node: node.getField("value"))


def find_paths(
    df: DataFrame,
    column: str,
    paths: list[str],
    names: list[str] | None = None,
    strict: bool = False,
    lists: str = "whole",
    nulls: str = "drop",
    max_depth: int | None = None,
) -> DataFrame:
    """Add one column per path: the value, or the list of values where the
    path occurs several times.

    ``missing`` lists the paths a row lacks; ``strict`` fails the query on
    such a row instead. In a typed record only the wanted fields are read.
    """
    if isinstance(paths, str):
        raise TypeError("paths must be a list of paths")
    _check(lists, nulls)
    names = names or [path.replace(".", "_") for path in paths]
    kept = [c for c in df.columns if c not in names]
    hits = [f"_hits_{i}" for i in range(len(paths))]
    dtype = df.select(F.col(column)).schema[0].dataType

    if isinstance(dtype, T.VariantType) or _has_maps(dtype):
        wanted = F.filter(
            "_nodes", lambda node: node.getField("path").isin(paths)
        )
        walked = _with_nodes(
            df, column, "_nodes", lists, nulls, max_depth
        ).withColumn("_nodes", wanted).select(
            *kept,
            *[
                _values_of("_nodes", path).alias(hit)
                for path, hit in zip(paths, hits)
            ],
        )
        listed = set(hits)
    else:
        found = [
            _typed_values(F.col(column), dtype, path, lists, nulls)
            for path in paths
        ]
        walked = df.select(
            *kept, *[values.alias(hit) for (values, _), hit in zip(found, hits)]
        )
        listed = {hit for (_, many), hit in zip(found, hits) if many}

    def is_absent(hit: str) -> Column:
        return F.size(hit) == 0 if hit in listed else F.col(hit).isNull()

    def result(hit: str) -> Column:
        if hit not in listed:
            return F.col(hit)
        several = F.concat(F.lit("["), F.array_join(hit, ","), F.lit("]"))
        return F.when(F.size(hit) == 1, F.get(hit, F.lit(0))).when(
            F.size(hit) > 1, several
        )

    absent = F.array_compact(
        F.array(
            *[
                F.when(is_absent(hit), F.lit(path))
                for path, hit in zip(paths, hits)
            ]
        )
    )
    out = walked.select(
        *kept,
        *[result(hit).alias(name) for hit, name in zip(hits, names)],
        absent.alias("missing"),
    )
    if not strict:
        return out
    complaint = F.concat(
        F.lit("paths not in record: "), F.array_join("missing", ", ")
    )
    return out.filter(
        F.when(F.size("missing") == 0, F.lit(True)).otherwise(
            F.raise_error(complaint).cast("boolean")
        )
    ).drop("missing")
