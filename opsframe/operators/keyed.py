"""Keyed lookups and writes, list membership and association edges.

The large table is always the left side of the join and is never broadcast
or grouped. Spark broadcasts the other side when its measured size allows and
sort-merges otherwise, where adaptive execution can split a hot left key.
No broadcast hints are given.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.operators.columns import select_properties

# The property of an update that names a contact and changes nothing else.
NO_PROPERTY = ""

EDGE_COLUMNS = [
    "object_type",
    "object_id",
    "to_object_type",
    "to_object_id",
    "association_type",
]


def _hashed(columns: list[str]) -> Column:
    """A hash to group by along with ``columns``; the groups stay the same.

    Adaptive execution splits a hot key only in a join whose inputs come
    straight from a shuffle. An aggregate by the join key alone is taken as
    partitioned already and sits between the two; one by key and hash is not.
    """
    return F.xxhash64(*columns).alias("_hash")


def _distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, _hashed(columns)).distinct().drop("_hash")


def _typed(target: DataFrame, keys: Iterable, key: str) -> list[Column]:
    """Listed keys as literals of the target's key type; NULL asks for none.

    The one place where listed keys are converted: ``"1"`` finds a BIGINT 1,
    and what is no number fails, however many keys there are.
    """
    dtype = target.schema[key].dataType
    return [F.lit(k).cast(dtype) for k in keys if k is not None]


def _key_table(target: DataFrame, keys, key: str) -> DataFrame:
    """Distinct non-NULL keys, typed like the target's key column."""
    if isinstance(keys, DataFrame):
        table = keys.select(F.col(key))
    else:
        listed = F.array(*_typed(target, keys, key)).cast(
            T.ArrayType(target.schema[key].dataType)
        )
        table = target.sparkSession.range(1).select(
            F.explode(listed).alias(key)
        )
    return _distinct(table.filter(F.col(key).isNotNull()), [key])


def lookup_batch(
    target: DataFrame,
    keys: DataFrame | Iterable,
    key: str,
    properties: list[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` whose key is asked for, with the chosen columns.

    Keys in a list become an IN filter, which the file scan can use; keys in
    a DataFrame a semi join, which is the form for many of them.
    """
    if not isinstance(keys, DataFrame):
        found = target.filter(F.col(key).isin(_typed(target, keys, key)))
    else:
        found = target.join(_key_table(target, keys, key), key, "left_semi")
    return select_properties(found, properties, always=[key])


def unmatched_keys(
    target: DataFrame, keys: DataFrame | Iterable, key: str
) -> DataFrame:
    """The asked-for keys that ``target`` does not hold."""
    wanted = _key_table(target, keys, key)
    return wanted.join(_held_keys(target, wanted, key), key, "left_anti")


def _held_keys(target: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The wanted keys present in ``target``.

    The semi join comes first: with few wanted keys the target is filtered
    where it lies instead of having all its keys shuffled.
    """
    return (
        target.select(key).join(wanted.select(key), key, "left_semi").distinct()
    )


def _required_key(key: str) -> Column:
    return F.coalesce(
        F.col(key),
        F.raise_error(F.lit(f"update without {key}")),
    )


def property_updates(
    contacts: DataFrame, key: str | list[str], seq: str, properties: str = "properties"
) -> DataFrame:
    """Contact updates -> rows ``(key, seq, pos, property, value)``.

    A contact without properties gives one row that names it, with
    ``NO_PROPERTY``. ``key`` may be several columns, such as id and email.
    """
    keys = [key] if isinstance(key, str) else list(key)
    items = contacts.select(
        *keys, seq, F.posexplode_outer(properties).alias("pos", "_item")
    )
    named = F.when(F.col("pos").isNull(), F.lit(NO_PROPERTY)).otherwise(
        F.col("_item.property")
    )
    return items.select(
        *keys, seq, "pos", named.alias("property"), "_item.value"
    )


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    seq: str | list[str],
    properties: list[str] | None = None,
    other_key: str | None = None,
) -> DataFrame:
    """Insert or update by key, changing only the properties that are named.

    ``updates`` has the columns ``key, property, value`` and those of ``seq``;
    for each key and property the record with the largest ``seq`` wins, an
    explicit NULL included. ``seq`` must order the records of a key. The
    property ``NO_PROPERTY`` names the contact alone, which inserts it when it
    is new; a NULL property fails the query.

    With ``other_key`` an update whose key is NULL is for the row of that other
    key, which ``updates`` then has as a column: the lowest key that has it, or
    a new row without a key. An update without either fails the query.
    """
    if other_key is not None:
        return _upsert_by_either(
            target, updates, key, seq, properties, other_key
        )
    named = updates.withColumn(key, _required_key(key))
    return _upsert_named(target, named, key, seq, properties)


def _upsert_named(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    seq: str | list[str],
    properties: list[str] | None,
) -> DataFrame:
    """``upsert`` of updates whose key is known to be set."""
    others = [c for c in target.columns if c != key]
    props = others if properties is None else list(properties)
    order = F.struct(*([seq] if isinstance(seq, str) else seq))

    allowed = F.col("property").isin([*props, NO_PROPERTY])
    unknown = F.max(
        F.when(F.col("property").isNull(), F.lit("NULL")).when(
            ~allowed, F.col("property")
        )
    )
    # The struct is NULL when a property is not named, and its field is NULL
    # when the property is set to NULL.
    latest = [
        F.max_by(
            F.when(F.col("property") == p, F.struct("value")),
            F.when(F.col("property") == p, order),
        ).alias(f"_new_{p}")
        for p in props
    ]
    collapsed = (
        updates.groupBy(key, _hashed([key]))
        .agg(*latest, unknown.alias("_unknown"))
        .filter(
            F.when(F.col("_unknown").isNull(), F.lit(True)).otherwise(
                F.raise_error(
                    F.concat(F.lit("unknown property: "), "_unknown")
                ).cast("boolean")
            )
        )
        .drop("_unknown", "_hash")
        # True of every row. Said here, it is the same in both joins below,
        # which can then share the shuffled updates.
        .filter(F.col(key).isNotNull())
    )

    def new_value(name: str) -> Column:
        field = F.col(f"_new_{name}").getField("value")
        return field.cast(target.schema[name].dataType)

    def merged(name: str) -> Column:
        if name not in props:
            return F.col(name)
        return (
            F.when(F.col(f"_new_{name}").isNotNull(), new_value(name))
            .otherwise(F.col(name))
            .alias(name)
        )

    def inserted(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name not in props:
            return F.lit(None).cast(target.schema[name].dataType).alias(name)
        return new_value(name).alias(name)

    kept = target.join(collapsed, key, "left").select(
        *[F.col(c) if c == key else merged(c) for c in target.columns]
    )
    # The keys alone: a hash aggregate without the property columns.
    named = _distinct(updates.filter(F.col(key).isNotNull()), [key])
    held = _held_keys(target, named, key)
    added = collapsed.join(held, key, "left_anti").select(
        *[inserted(c) for c in target.columns]
    )
    return kept.unionByName(added)


def _upsert_by_either(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    seq: str | list[str],
    properties: list[str] | None,
    other: str,
) -> DataFrame:
    """``upsert`` of updates that name a row by ``key`` or else by ``other``."""
    order = [seq] if isinstance(seq, str) else list(seq)
    fields = [*order, "property", "value"]
    by_other = F.col(key).isNull()
    wanted = _distinct(
        updates.filter(by_other & F.col(other).isNotNull()), [other]
    )
    # The other key of every row as the keyed updates of this batch leave it:
    # a row whose other key they change loses the old value and has the new
    # one, and a row they insert is found by the value they give it.
    changed = (
        updates.filter(
            F.col(key).isNotNull() & (F.col("property") == F.lit(other))
        )
        .groupBy(key)
        .agg(F.max_by("value", F.struct(*order)).alias("_now"))
    )
    kept = (
        target.filter(F.col(key).isNotNull())
        .join(wanted, other, "left_semi")
        .join(changed, key, "left_anti")
        .select(F.col(other).cast("string").alias("_other"), key)
    )
    given = changed.filter(F.col("_now").isNotNull()).select(
        F.col("_now").alias("_other"), key
    )
    known = (
        kept.unionByName(given)
        .join(
            wanted.select(F.col(other).cast("string").alias("_other")),
            "_other",
            "left_semi",
        )
        .groupBy(F.col("_other").alias(other))
        .agg(F.min(key).alias("_known"))
    )
    located = updates.join(
        known.withColumnRenamed(other, "_other"),
        by_other & (F.col(other).cast("string") == F.col("_other")),
        "left",
    ).withColumn(key, F.coalesce(key, "_known"))
    nameless = F.raise_error(F.lit(f"update without {key} and {other}"))
    located = located.filter(
        F.when(F.coalesce(F.col(key).cast("string"), other).isNotNull(), True)
        .otherwise(nameless.cast("boolean"))
    )
    keyed = located.filter(F.col(key).isNotNull()).select(key, *fields)
    fresh = located.filter(by_other).select(other, *fields)
    props = [c for c in target.columns if c not in (key, other)]
    props = props if properties is None else list(properties)
    # Rows of new contacts: an upsert into an empty table, by the other key.
    empty = target.drop(key).filter(F.lit(False))
    made = _upsert_named(
        empty, fresh, other, seq, [p for p in props if p != other]
    ).withColumn(key, F.lit(None).cast(target.schema[key].dataType))
    merged = _upsert_named(target, keyed, key, seq, properties)
    return merged.unionByName(made.select(target.columns))


def _one_per_key(
    updates: DataFrame, key: str, seq: str | None
) -> DataFrame:
    """``(key, _row)`` with the winning record of every key."""
    record = F.struct(*[F.col(c) for c in updates.columns if c != key])
    keyed = updates.withColumn(key, _required_key(key)).groupBy(
        key, _hashed([key])
    )
    if seq is not None:
        latest = F.max_by(record, F.col(seq))
        return keyed.agg(latest.alias("_row")).drop("_hash")
    single = F.when(F.count(F.lit(1)) == 1, F.any_value(record)).otherwise(
        F.raise_error(F.lit(f"several updates for one {key}; give seq"))
    )
    return keyed.agg(single.alias("_row")).drop("_hash")


def _mask_tree(mask: Iterable[str]) -> dict:
    tree: dict = {}
    for path in mask:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
            if node is None:
                break
        else:
            node[leaf] = None
    return tree


def _overlay(
    old: Column, new: Column, dtype: T.DataType, tree: dict | None
) -> Column:
    """``old`` with the masked fields taken from ``new``."""
    if tree is None:
        return new
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"mask reaches below a {dtype.simpleString()}")
    absent = [name for name in tree if name not in dtype.names]
    if absent:
        raise ValueError(f"mask names unknown fields {absent}")
    fields = []
    for field in dtype.fields:
        before, after = old.getField(field.name), new.getField(field.name)
        value = (
            _overlay(before, after, field.dataType, tree[field.name])
            if field.name in tree
            else before
        )
        fields.append(value.alias(field.name))
    both_null = old.isNull() & new.isNull()
    return F.when(~both_null, F.struct(*fields))


def masked_update(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    mask: list[str] | None = None,
    mask_column: str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Overwrite only the masked fields of the matching rows, NULLs included.

    ``mask`` lists column names or dotted paths and holds for every update.
    ``mask_column`` names an ``array<string>`` column of ``updates`` with each
    record's own mask of top-level columns. Keys not in ``target`` add no row.
    Without ``seq`` a second update for one key fails the query.
    """
    if (mask is None) == (mask_column is None):
        raise ValueError("give either mask or mask_column")
    winners = _one_per_key(updates, key, seq).withColumn(
        "_matched", F.lit(True)
    )
    joined = target.join(winners, key, "left")
    row = F.col("_row")
    matched = F.col("_matched").isNotNull()

    if mask is not None:
        tree = _mask_tree(mask)
        absent = [n for n in tree if n not in target.columns or n == key]
        if absent:
            raise ValueError(f"mask names unknown fields {absent}")

    def value(field: T.StructField) -> Column:
        old = F.col(field.name)
        if mask_column is not None:
            if field.name == key or field.name not in updates.columns:
                return old
            asked = F.array_contains(
                row.getField(mask_column), F.lit(field.name)
            )
            return (
                F.when(asked, row.getField(field.name))
                .otherwise(old)
                .alias(field.name)
            )
        if field.name not in tree:
            return old
        new = _overlay(
            old, row.getField(field.name), field.dataType, tree[field.name]
        )
        return F.when(matched, new).otherwise(old).alias(field.name)

    return joined.select(*[value(f) for f in target.schema.fields])


def delete_keys(
    target: DataFrame, keys: DataFrame | Iterable, key: str
) -> tuple[DataFrame, DataFrame]:
    """``(remaining rows, removed keys)``; keys in a list become a filter, keys
    in a DataFrame a join."""
    if not isinstance(keys, DataFrame):
        gone = F.col(key).isin(_typed(target, keys, key))
        remaining = target.filter(~F.coalesce(gone, F.lit(False)))
        removed = target.filter(gone).select(key).distinct()
        return remaining, removed
    listed = _key_table(target, keys, key)
    remaining = target.join(listed, key, "left_anti")
    return remaining, _held_keys(target, listed, key)


def delete_all(target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(no rows, all keys)``."""
    return target.filter(F.lit(False)), target.select(key).distinct()


def add_members(
    members: DataFrame,
    list_id,
    contacts: DataFrame | None = None,
    emails: DataFrame | list[str] | None = None,
    vids: DataFrame | list | None = None,
) -> DataFrame:
    """Add contacts, named by email or id, to a static list.

    ``members`` has ``list_id, vid`` and ``contacts`` has ``vid, email``.
    Emails that belong to no contact add nobody.
    """
    if _absent(emails) and _absent(vids):
        raise ValueError("emails or vids are required")
    dtype = members.schema["vid"].dataType
    added = []
    if not _absent(vids):
        if not isinstance(vids, DataFrame):
            vids = _key_table(members, vids, "vid")
        added.append(vids.select(F.col("vid").cast(dtype).alias("vid")))
    if not _absent(emails):
        if contacts is None:
            raise ValueError("contacts are needed to resolve emails")
        found = lookup_batch(
            contacts.select("vid", "email"), emails, "email", ["vid"]
        )
        added.append(found.select(F.col("vid").cast(dtype).alias("vid")))
    rows = added[0] if len(added) == 1 else added[0].unionByName(added[1])
    listed = F.lit(list_id).cast(members.schema["list_id"].dataType)
    fresh = rows.filter(F.col("vid").isNotNull()).select(
        listed.alias("list_id"), "vid"
    )
    return _append_new(
        members.select("list_id", "vid"), fresh, ["list_id", "vid"]
    )


def _append_new(
    existing: DataFrame, added: DataFrame, columns: list[str]
) -> DataFrame:
    """``existing``, a set, plus the rows of ``added`` it does not hold.

    Only the few rows found in both are compared with the additions, so that
    a small addition leaves the existing rows unshuffled.
    """
    fresh = _distinct(added, columns)
    held = existing.join(fresh, columns, "left_semi")
    return existing.unionByName(fresh.join(held, columns, "left_anti"))


def _absent(values) -> bool:
    return values is None or (
        not isinstance(values, DataFrame) and not list(values)
    )


def list_members(
    members: DataFrame,
    contacts: DataFrame,
    list_id=None,
    properties: list[str] | None = None,
) -> DataFrame:
    """The contacts of one list, or of every list, with chosen properties."""
    listed = members.select("list_id", "vid")
    if list_id is not None:
        listed = listed.filter(F.col("list_id") == list_id)
    chosen = select_properties(contacts, properties, always=["vid"])
    return listed.join(chosen, "vid").select(
        "list_id", "vid", *[c for c in chosen.columns if c != "vid"]
    )


def contact_lists(members: DataFrame, list_id=None) -> DataFrame:
    """Every list, or the one asked for, with its size."""
    if list_id is not None:
        members = members.filter(F.col("list_id") == list_id)
    return members.groupBy("list_id").agg(F.count(F.lit(1)).alias("size"))


def associate(edges: DataFrame, added: DataFrame) -> DataFrame:
    """Add typed object-to-object edges; an edge present already stays one.

    All five columns of an edge are set; one without them fails the query.
    """
    incomplete = F.raise_error(F.lit("edge with a missing column"))
    complete = F.when(
        F.concat(*EDGE_COLUMNS).isNotNull(), F.lit(True)
    ).otherwise(incomplete.cast("boolean"))
    added = added.filter(complete)
    return _append_new(
        edges.select(*EDGE_COLUMNS), added.select(*EDGE_COLUMNS), EDGE_COLUMNS
    )
