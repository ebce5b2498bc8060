"""Sharding by jump consistent hashing (Lamping and Veach, 2014), as plain column expressions.

The shard of a key follows from the key and the number of shards alone: no ring table, no state. Appending
a shard moves only the keys that jump into it. Everything is DataFrame functions on the JVM.

Defined results: a null key counts as key 0; a null text has no bytes; equal rows get different slots; an
empty table gives an empty result; other columns of the input, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LCG = 2862933555777941757  # multiplier of the published algorithm
ROW_OVERHEAD = 8
BLOCKS = 256  # sub-groups of a shard that are numbered apart


def _lcg_step(k: Column) -> Column:
    """k * LCG + 1 modulo 2**64 in 16-bit limbs: no intermediate leaves the range of a long (ANSI-safe)."""
    limb = [F.shiftrightunsigned(k, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    c = [(LCG >> (16 * i)) & 0xFFFF for i in range(4)]
    carry: Column = F.lit(1).cast("long")
    parts = []
    for i in range(4):
        column = carry
        for j in range(i + 1):
            column = column + limb[j] * F.lit(c[i - j]).cast("long")
        parts.append(F.shiftleft(column.bitwiseAND(F.lit(0xFFFF)), 16 * i))
        carry = F.shiftrightunsigned(column, 16)
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])


def jump(key: Column, shards: int) -> Column:
    """struct<shard, next>: the bucket of ``key`` among ``shards``, and the first later jump target.

    With one more shard the key goes to shard ``shards`` exactly if ``next`` equals ``shards``.
    """
    start = F.struct(key.cast("long").alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        moved = F.transform(F.array(_lcg_step(s["k"])), lambda k: F.struct(
            k.alias("k"),
            s["j"].alias("b"),
            ((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftrightunsigned(k, 33) + 1).cast("double")))
            .cast("long").alias("j")))[0]
        return F.when(s["j"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step,
                       lambda s: F.struct(s["b"].cast("int").alias("shard"), s["j"].alias("next")))


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """key, size (UTF-8 bytes + 8), text_crc32, shard, slot (gapless from 0 in the shard), grown_shard.

    Slots come from a prefix sum over ``blocks`` hash blocks of each shard (a broadcast table of at most
    ``shards * blocks`` rows) plus a row number inside the block, so no shard is ever one task's work.
    """
    placed = lambda d: (
        d.withColumn("_j", jump(F.coalesce(F.col("_key"), F.lit(0)), shards))
        .withColumn("_block", F.pmod(F.xxhash64("_key", F.lit("block")), F.lit(blocks)).cast("int"))
        .withColumn("shard", F.col("_j.shard")))
    keys = placed(df.select(F.col(key).cast("long").alias("_key")))
    per_block = keys.groupBy("shard", "_block").count()
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("shard", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = placed(df.select(
        F.col(key).cast("long").alias("_key"),
        (F.octet_length(body).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32")))
    in_block = Window.partitionBy("shard", "_block").orderBy("_key", "text_crc32", "size")
    return (
        rows.join(F.broadcast(offsets), ["shard", "_block"])
        .select(
            F.col("_key").alias(key), "size", "text_crc32", "shard",
            (F.col("_before") + F.row_number().over(in_block) - 1).cast("long").alias("slot"),
            F.when(F.col("_j.next") == shards, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("grown_shard"))
    )
