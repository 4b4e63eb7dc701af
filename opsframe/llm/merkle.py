"""Merkle manifest of a table: leaves, subroots per group, one root, proofs.

Every row is a leaf, the hash of its fields. Inside a group (``lang``) leaves
ascend by ``doc_id``; each level pairs consecutive nodes into the hash of their
hex digests, a last lone node becomes the hash of itself, and what is left is
the group's subroot. Subroots, ordered by group (null first, bytewise), give
the root the same way. A proof lists, level by level, the sibling of a leaf's
ancestor up to the root.

Method: nested-struct rollup in bounded blocks. A node's rank splits into
digits of ``BLOCK_LEVELS`` bits. Grouping by all but the lowest digit gathers
at most ``2^BLOCK_LEVELS`` child structs into one row; array functions hash
that block's levels and give each child its siblings inside the block; the
block's top node is the next stage's node, whose rank lost one digit. After
the last stage ``transform`` and ``explode`` hand every node its steps.

Departure: the named method nests the children of every stage inside their
parent and explodes proofs from the top without a join. Its top row would hold
a whole group (a language may hold a third of a corpus), so a row here holds one
block only, and the steps of upper stages come down by an equi-join on
``(group, rank)`` per stage. Every join key is a block, never a hot group; the
table of subroots is joined to the leaves by group, broadcast only under
``BROADCAST_GROUPS`` rows.

All hashing is in column expressions (``sha2``, ``aggregate``, ``transform``);
no Python runs on rows.

Defined results: a null field is encoded as ``-``; a null group is one group,
first in order; a group of one leaf has that leaf as subroot, and a table of
one group has that subroot as root; rows tied on ``doc_id`` follow the order of
their leaf digests, and repeated rows are leaves of their own; a null
``doc_id`` sorts first and is never tampered; an empty table gives no rows;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import stored
from opsframe.operators.batching import index_rows

# Fixed encoding: fields in this order, null as "-", else byte count, ":" and
# the value (integers in decimal).
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NULL_FIELD = "-"
# Levels hashed inside one block: at most 2^10 children per row of a stage.
BLOCK_LEVELS = 10
# Rows of the per-group table (subroot, steps, root) that may be broadcast.
BROADCAST_GROUPS = 100_000
# A row is tampered when this divides the unsigned crc32 of its decimal id.
TAMPER_EVERY = 7


def H(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts concatenated as text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit(NULL_FIELD)).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_of(values: dict[str, Column]) -> Column:
    """Digest of a row from its fields."""
    return H(*(field(values[name]) for name in FIELDS))


def _shr(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _bits(m: Column) -> Column:
    """Levels that pair ``m`` nodes down to one: ceil(log2(m)), 0 for 1."""
    return F.when(m <= 1, F.lit(0)).otherwise(F.length(F.bin(m - 1)))


def _up(level: Column) -> Column:
    """The next level: pairs hashed, a last lone node hashed by itself."""
    pairs = F.sequence(
        F.lit(0), F.ceil(F.size(level) / 2).cast("int") - 1
    )
    return F.transform(
        pairs,
        lambda i: F.when(
            2 * i + 1 < F.size(level),
            H(F.get(level, 2 * i), F.get(level, 2 * i + 1)),
        ).otherwise(H(F.get(level, 2 * i))),
    )


def _stage(nodes: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """One stage over nodes ``(_g, _r, _h, _m, *carry)`` of groups with more
    than one node (``_m`` nodes each).

    Returns the steps of every node ``(_g, _r, _h, _steps, *carry)`` and the next
    stage's nodes ``(_g, _r, _h, _m)``.
    """
    levels = F.least(F.lit(BLOCK_LEVELS), _bits(F.col("_m")))
    kids = F.sort_array(
        F.collect_list(F.struct("_r", "_h", *carry))
    ).alias("_kids")
    blocks = (
        nodes.groupBy(
            "_g", F.shiftright("_r", BLOCK_LEVELS).alias("_b"), "_m"
        )
        .agg(kids)
        .withColumn("_n", levels)
        .withColumn(
            "_lv",
            F.aggregate(
                F.sequence(F.lit(1), F.col("_n")),
                F.array(F.transform("_kids", lambda k: k["_h"])),
                lambda acc, _: F.concat(
                    acc, F.array(_up(F.element_at(acc, -1)))
                ),
            ),
        )
    )

    def steps(i: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.col("_n") - 1),
            lambda j: F.struct(
                F.get(
                    F.get(F.col("_lv"), j),
                    _shr(i, j).bitwiseXOR(F.lit(1)),
                ).alias("sib"),
                (_shr(i, j) % 2 == 0).alias("left"),
            ),
        )

    blocks = stored(blocks, "merkle-blocks")
    emitted = blocks.select(
        "_g",
        F.explode(
            F.transform(
                "_kids",
                lambda k, i: F.struct(
                    k["_r"].alias("_r"),
                    k["_h"].alias("_h"),
                    steps(i).alias("_steps"),
                    *(k[c].alias(c) for c in carry),
                ),
            )
        ).alias("_k"),
    ).select("_g", "_k.*")
    upper = blocks.select(
        "_g",
        F.col("_b").alias("_r"),
        F.get(F.element_at("_lv", -1), 0).alias("_h"),
        (_shr(F.col("_m") - 1, F.col("_n")) + 1).alias("_m"),
    )
    return emitted, upper


def tree(
    nodes: DataFrame, carry: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Steps of every node and the top of every group.

    ``nodes``: ``(_g, _r, _h, _m, *carry)`` with ranks 0 to ``_m - 1`` inside
    each group. Returns ``(_g, _r, _h, _steps, *carry)`` for every node, steps
    from its own level up, and ``(_g, _top)`` for every group.
    """
    carry = list(carry)
    top_m = nodes.agg(F.max("_m")).first()[0] or 0
    stages = -(-(max(top_m - 1, 0)).bit_length() // BLOCK_LEVELS)
    tops = [nodes.where("_m = 1").select("_g", F.col("_h").alias("_top"))]
    lone = nodes.where("_m = 1").select(
        "_g", "_r", "_h", F.array().cast(STEPS).alias("_steps"), *carry
    )
    layers = []
    current = nodes.where("_m > 1")
    for _ in range(stages):
        emitted, upper = _stage(current, carry)
        carry = []
        layers.append(emitted)
        tops.append(upper.where("_m = 1").select("_g", F.col("_h").alias("_top")))
        current = upper.where("_m > 1")
    if not layers:
        return lone, _union(tops)
    above = layers[-1]
    for below in reversed(layers[:-1]):
        above = stored(
            below.alias("b")
            .join(
                above.alias("a"),
                F.col("b._g").eqNullSafe(F.col("a._g"))
                & (F.shiftright("b._r", BLOCK_LEVELS) == F.col("a._r")),
                "left",
            )
            .select(
                "b.*",
                F.concat(
                    F.col("b._steps"),
                    F.coalesce("a._steps", F.array().cast(STEPS)),
                ).alias("_all"),
            )
            .drop("_steps")
            .withColumnRenamed("_all", "_steps"),
            "merkle-steps",
        )
    return above.unionByName(lone), _union(tops)


STEPS = "array<struct<sib:string,left:boolean>>"


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _small(df: DataFrame) -> DataFrame:
    """A per-group table, written; hinted for broadcast under the bound."""
    df = stored(df, "merkle-groups")
    return F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df


def fold(start: Column, steps: Column) -> Column:
    """The root reached from a node by its steps."""
    return F.aggregate(
        steps,
        start,
        lambda acc, s: F.when(s["sib"].isNull(), H(acc))
        .when(s["left"], H(acc, s["sib"]))
        .otherwise(H(s["sib"], acc)),
    )


def manifest(docs: DataFrame, group: str = "lang") -> DataFrame:
    """Leaf, subroot, root, proof digest and tamper check of every row.

    Returns ``doc_id, lang, leaf, subroot, root, proof_sha256, folded_root,
    verified``: the proof digest is the hash of the siblings' hex digests
    concatenated from the leaf up; ``folded_root`` is recomputed from the
    tampered leaf (``n_chars`` plus one where ``TAMPER_EVERY`` divides the
    crc32 of the decimal id; nulls stay) and the original siblings.
    """
    values = {name: F.col(name) for name in FIELDS}
    tamper = (
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY
        == 0
    )
    changed = dict(
        values,
        n_chars=F.when(tamper, F.col("n_chars") + 1).otherwise(
            F.col("n_chars")
        ),
    )
    leaves = docs.select(
        F.col("doc_id"),
        F.col(group).alias("_g"),
        leaf_of(values).alias("_h"),
        leaf_of(changed).alias("_t"),
    )
    ranked = stored(
        index_rows(leaves, ["doc_id", "_h"], "_r", within=["_g"]),
        "merkle-leaves",
    )
    counts = _small(
        ranked.groupBy(F.col("_g").alias("_c")).agg(F.count("*").alias("_m"))
    )
    nodes = ranked.join(counts, F.col("_g").eqNullSafe(F.col("_c"))).select(
        "_g", "_r", "_h", "_m", "doc_id", "_t"
    )
    leaf_steps, subroots = tree(nodes, ["doc_id", "_t"])
    ranked_groups = index_rows(
        subroots.select(F.col("_g").alias("_lang"), F.col("_top").alias("_h")),
        [F.col("_lang").asc_nulls_first()],
        "_r",
    )
    # Two scalars reach the driver: the number of groups and the root.
    total = ranked_groups.count()
    group_nodes = ranked_groups.select(
        F.lit(0).alias("_g"), "_r", "_h", F.lit(total).alias("_m"), "_lang"
    )
    group_steps, roots = tree(group_nodes, ["_lang"])
    root = roots.first()
    per_group = _small(
        group_steps.select(
            F.col("_lang"),
            F.col("_h").alias("subroot"),
            F.col("_steps").alias("_up"),
            F.lit(root["_top"] if root else None).alias("root"),
        )
    )
    steps = F.concat("_steps", "_up")
    return (
        leaf_steps.join(per_group, F.col("_g").eqNullSafe(F.col("_lang")))
        .select(
            "doc_id",
            F.col("_g").alias(group),
            F.col("_h").alias("leaf"),
            "subroot",
            "root",
            F.sha2(
                F.array_join(F.transform(steps, lambda s: s["sib"]), ""), 256
            ).alias("proof_sha256"),
            fold(F.col("_t"), steps).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
