"""Sharding by jump consistent hashing, in DataFrame functions only.

A key's shard is found without a ring table: a 64-bit linear congruential
sequence seeded with the key gives the shard counts at which the key jumps to
the newest shard. With one more shard a key either stays or moves into the new
one, so only the necessary fraction of rows moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.common import staged

#: Fixed value: the multiplier of the published jump hash.
MULTIPLIER = 2862933555777941757
_LOW32 = 0xFFFFFFFF


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64, on 32-bit halves so that no product passes 62 bits."""
    m_hi, m0, m1 = MULTIPLIER >> 32, MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF
    upper = lo * m1
    total = lo * m0 + F.shiftleft(upper.bitwiseAND(_LOW32), 16) + 1
    carry = F.shiftright(total, 32) + F.shiftleft(F.shiftright(upper, 32), 16)
    cross = (lo * m_hi).bitwiseAND(_LOW32) + (hi * m0).bitwiseAND(_LOW32) + F.shiftleft((hi * m1).bitwiseAND(0xFFFF), 16)
    return (carry + cross).bitwiseAND(_LOW32), total.bitwiseAND(_LOW32)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (0 to shards - 1) of a 64-bit integer key; a null key counts as 0.

    Each step raises the jump target, so ``shards`` steps always suffice.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next(s["hi"], s["lo"])
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(2.0**31) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(s["j"] >= shards, s).otherwise(
            F.struct(s["j"].alias("b"), jump.alias("j"), hi.alias("hi"), lo.alias("lo"))
        )

    # the first step from b = -1, j = 0 is the same step with b = 0
    start = F.struct(
        F.lit(0).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(_LOW32).alias("lo"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard_rows(df: DataFrame, key: str, text: str, shards: int = 16) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row.

    ``size`` is the UTF-8 length of the text plus 1 (1 for null), ``slot`` the
    row's rank by key in its shard, gapless from 0, ``grown_shard`` the shard
    with one more shard. A null key is sharded like 0 and ranks first; rows with
    equal keys share a shard and get different slots in any order. An empty
    table gives an empty result.

    The text is read once and only its length and checksum go on. Slots come
    from one range sort over (shard, key, row tag): the tag splits a key that
    holds many rows, and a table of one row per task and shard holds the offsets.
    """
    k, t = F.col(key), F.col(text)
    rows = df.select(
        k.alias("k"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        jump_hash(k, shards).alias("shard"),
        jump_hash(k, shards + 1).alias("grown_shard"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tag"),
    )
    rows = staged(rows, "shard-rows")
    sort = ["shard", "k", "tag"]
    placed = rows.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("tag")
    placed = placed.select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place"))
    placed = staged(placed, "shard-order")
    counts = placed.groupBy("task", "shard").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # a task's shards are neighbours in the sort: at most tasks + shards rows here
    counts = counts.selectExpr(
        "task",
        "shard",
        "first - (sum(n) OVER (PARTITION BY shard ORDER BY task) - n) AS shift",
    )
    out = placed.join(counts, ["task", "shard"])
    return out.select(
        F.col("k").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("shift")).alias("slot"),
        "grown_shard",
    )
