"""Sharding by jump consistent hashing, in column expressions only.

A key jumps upwards through shard numbers; the last jump below the number of
shards is its shard. Each jump depends on the key and on where it stands, not
on the number of shards, so one more shard takes the keys whose next jump lands
on it and moves no other. There is no ring table to keep or to broadcast.

The random draw of a jump is ``xxhash64(key, position)``. In front of the
exchange a row is cut down to its key and digests, and the rows of a shard are
numbered in parts, so that no task holds a shard as a whole.

Defined results: a null key is one key like any other and goes to one shard; a
null text has no bytes and the checksum of no bytes; repeated rows have slots
of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BYTES = 16
# Parts in which each shard is numbered; more parts spread a shard over more
# tasks and cost one row of counts each.
PARTS = 1024


def jump_hash(key: Column, shards: Column) -> Column:
    """Shard of a key, from 0, as an integer column.

    A jump from shard b lands on floor((b + 1) * 2^31 / r) with r drawn
    evenly from 1 to 2^31, which is above b; so no more jumps than shards are
    needed and the fold over them always reaches the end.
    """
    draw = lambda at: (
        F.shiftrightunsigned(F.xxhash64(key, at), 33) + 1
    )
    state = F.struct(
        F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("at")
    )

    def step(s: Column, _: Column) -> Column:
        beyond = s["at"] >= shards
        jump = F.floor(
            (s["at"] + 1).cast("double") * (1 << 31) / draw(s["at"])
        ).cast("long")
        return F.struct(
            F.when(beyond, s["last"]).otherwise(s["at"]).alias("last"),
            F.when(beyond, s["at"]).otherwise(jump).alias("at"),
        )

    return F.aggregate(
        F.sequence(F.lit(1).cast("long"), shards.cast("long")), state, step
    )["last"].cast("int")


def shard_rows(
    docs: DataFrame, shards: int, key: str = "doc_id", parts: int = PARTS
) -> DataFrame:
    """``key``, size, checksum, shard, slot in it and shard after growing by
    one.

    A row's part within its shard is a hash of all it is numbered by and of
    the input partition it was read in, so that copies of one row spread too.
    Counts of parts give each part its first slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        jump_hash(F.col(key), F.lit(shards)).alias("shard"),
        jump_hash(F.col(key), F.lit(shards + 1)).alias("grown_shard"),
    ).withColumn(
        "part",
        F.pmod(
            F.xxhash64(key, "size", "text_crc32", F.spark_partition_id()),
            F.lit(parts),
        ),
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    firsts = (
        rows.groupBy("shard", "part")
        .agg(F.count("*").alias("rows"))
        .select(
            "shard",
            "part",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
        )
    )
    within = Window.partitionBy("shard", "part").orderBy(
        key, "text_crc32", "size"
    )
    return (
        rows.withColumn("at", F.row_number().over(within) - 1)
        .join(firsts, ["shard", "part"])
        .select(
            key,
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("first") + F.col("at")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
