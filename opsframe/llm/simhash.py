"""SimHash near-duplicates over a byte-position inverted index.

A fingerprint has eight bytes. Two that differ in at most three bits differ in
at most three bytes, so they share at least five bytes at their positions: that
is the guaranteed minimum a pair must reach in the tally before its bits are
compared. Lists of single bytes would each hold a 256th of all fingerprints, so
the index lists combinations of positions: of any five positions at least three
lie in one half of the eight, and each combination of three positions within a
half is a list key. A pair is tallied in the first list that has both and in no
other. Fingerprints of a list longer than ``HOT_LIST`` are listed again by five
shared positions, which every pair of that list must have.

Equal texts have equal fingerprints and are one entry of the index, whatever
their number.

Departure from the named count filter: a pair is not tallied by counting the
posting lists it shares. Since each key already fixes three shared bytes and a
pair meets in one list only, its count of shared positions is read from the
two fingerprints when it meets, and the bit distance is checked at once; the
count filter, five shared bytes at least, is thereby implied by the distance
of three bits and filters nothing that the check would keep. No link is lost:
every pair within three bits shares a key.

Defined results: a null, empty or blank text has fingerprint zero and is linked
like any other; repeated rows are in one component; a null id is never the
smallest, and a component of null ids only has a null component id; an empty
table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import batch, stored, text_bytes
from opsframe.llm.components import components

BYTES = 8
SEED = 42
HOT_LIST = 2000
# Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(data: bytes, width: int) -> int:
    """Majority bits of the hashes of a text's shingles, as a signed long."""
    words = data.lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, shingles, BLOCK):
        end = min(start + BLOCK, shingles)
        if len(words) < width:
            texts = [b" ".join(words)]
        else:
            texts = map(
                b" ".join,
                zip(*(words[start + k : end + k] for k in range(width))),
            )
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(x, SEED) for x in texts), np.uint64
        )
        bits = np.unpackbits(
            hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > shingles, bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, width: int = 3, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns and ``_fp`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            schema = pa.schema([*list(rows.schema)[:-1], ("_fp", pa.int64())])
            *kept, texts = rows.columns
            found = [fingerprint(x, width) for x in texts.to_pylist()]
            yield batch(schema, *kept, found)

    kept = ", ".join(
        f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep
    )
    return docs.select(
        *(F.col(f"`{c}`") for c in keep), text_bytes().alias("_text")
    ).mapInArrow(run, f"{kept}, _fp long")


def list_positions(shared: int) -> list[tuple[int, ...]]:
    """Combinations of which every choice of ``shared`` positions has one."""
    half = BYTES // 2
    size = (shared + 1) // 2
    return [
        c
        for first in (0, half)
        for c in combinations(range(first, first + half), size)
    ]


def byte_at(fp: Column, position: int) -> Column:
    return F.shiftright(fp, 8 * position).bitwiseAND(0xFF)


def list_key(fp: Column, positions: tuple[int, ...]) -> Column:
    """The bytes at some positions as one number."""
    key = F.lit(0).cast("long")
    for position in positions:
        key = F.shiftleft(key, 8).bitwiseOR(byte_at(fp, position))
    return key


def listed(fps: DataFrame, lists: dict[int, tuple[int, ...]]) -> DataFrame:
    """A row for each fingerprint and list: list number, key, ``fp``."""
    entries = F.array(
        *(
            F.struct(
                F.lit(number).alias("list"),
                list_key(F.col("fp"), positions).alias("key"),
            )
            for number, positions in lists.items()
        )
    )
    return fps.select("fp", F.inline(entries))


def first_list(differing: Column, lists: dict[int, tuple[int, ...]]) -> Column:
    """The first list in which a pair with these differing bits meets."""
    found = F.lit(None).cast("int")
    for number, positions in reversed(lists.items()):
        mask = sum(0xFF << (8 * p) for p in positions)
        mask -= (mask >> 63) << 64
        found = F.when(differing.bitwiseAND(mask) == 0, number).otherwise(found)
    return found


def pairs_of(
    index: DataFrame, lists: dict, shared: int, max_bits: int
) -> DataFrame:
    """Pairs of one list that reach the tally and whose bits agree."""
    left = index.alias("l")
    right = index.alias("r")
    differing = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    tally = sum(
        F.when(byte_at(differing, p) == 0, 1).otherwise(0)
        for p in range(BYTES)
    )
    return left.join(
        right,
        (F.col("l.list") == F.col("r.list"))
        & (F.col("l.key") == F.col("r.key"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (tally >= shared)
        & (F.bit_count(differing) <= max_bits)
        & (first_list(differing, lists) == F.col("l.list")),
    ).select(F.col("l.fp").alias("u"), F.col("r.fp").alias("v"))


def linked(
    fps: DataFrame, max_bits: int = 3, hot_list: int = HOT_LIST
) -> DataFrame:
    """All pairs ``u`` < ``v`` of different ``fp`` within ``max_bits``."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be from 0 to 7")
    shared = BYTES - max_bits
    positions = list_positions(shared)
    lists = dict(enumerate(positions))
    index = stored(listed(fps, lists), "byte-index")
    long = (
        index.groupBy("list", "key")
        .count()
        .where(F.col("count") > hot_list)
        .select("list", "key")
    )
    long = stored(long, "long-lists")
    short = index.join(long, ["list", "key"], "left_anti")
    # Within a long list: each set of positions a pair may share there.
    finer = {
        number: c
        for number, c in enumerate(combinations(range(BYTES), shared))
    }
    of_list = {
        number: [n for n, c in finer.items() if set(c) >= set(base)]
        for number, base in lists.items()
    }
    wanted = F.create_map(
        *(
            x
            for number, sets in of_list.items()
            for x in (F.lit(number), F.array(*map(F.lit, sets)))
        )
    )
    members = (
        index.join(long, ["list", "key"], "left_semi")
        .select("fp", F.explode(wanted[F.col("list")]).alias("list"))
        .distinct()
    )
    key = F.lit(None).cast("long")
    for number, c in finer.items():
        key = F.when(F.col("list") == number, list_key(F.col("fp"), c)).otherwise(
            key
        )
    fine = members.select("fp", "list", key.alias("key"))
    return pairs_of(short, lists, shared, max_bits).union(
        pairs_of(fine, finer, shared, max_bits)
    )


def roots(rows: DataFrame, max_bits: int) -> DataFrame:
    """``_fp`` and ``_root``, the lowest fingerprint of its component, for each
    different fingerprint of the rows."""
    fps = stored(rows.select(F.col("_fp").alias("fp")).distinct(), "fps")
    parts = components(linked(fps, max_bits))
    return fps.join(parts, fps["fp"] == parts["node"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("_root")
    )


def near_duplicates(
    docs: DataFrame, width: int = 3, max_bits: int = 3
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of each row."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    rooted = stored(roots(rows, max_bits), "roots")
    lows = (
        rows.groupBy("_fp")
        .agg(F.min("doc_id").alias("low"))
        .join(rooted, "_fp")
        .groupBy("_root")
        .agg(F.min("low").alias("component_id"))
    )
    labels = rooted.join(lows, "_root").select("_fp", "component_id")
    return rows.join(labels, "_fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, width: int = 3, max_bits: int = 3
) -> DataFrame:
    """The columns of ``docs`` for one row of each component: the one with the
    lowest id, nulls last, and among those with that id the first read."""
    numbered = docs.withColumn("_uid", F.monotonically_increasing_id())
    rows = stored(
        fingerprints(numbered, width, tuple(numbered.columns)), "fingerprints"
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "_uid")
    lowest = rows.groupBy("_fp").agg(F.min(first).alias("first"))
    chosen = (
        lowest.join(roots(rows, max_bits), "_fp")
        .groupBy("_root")
        .agg(F.min("first").alias("first"))
        .select("first._uid")
    )
    return rows.join(chosen, "_uid", "left_semi").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
