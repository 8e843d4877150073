"""Shards by jump consistent hashing (Lamping and Veach, 2014), DataFrame functions only.

A key walks through a fixed sequence of jumps that depends on the key alone; its shard among
``n`` is the last stop below ``n``. With one shard more a key either stays or jumps into the
new shard, and no table of the ring is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.operators.ranking import running_total

# The multiplier of the paper's 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
LOW32 = 0xFFFFFFFF
# Positions inside a shard are counted in so many blocks on their own.
BLOCKS = 1021
# Copies of one row are spread out in two steps of at most so many rows each.
COPIES = 4096


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """One step of the generator on a key in two 32-bit halves.

    Done in 16-bit limbs of the multiplier, so no product or sum leaves a signed long (a
    plain product would raise an overflow in ANSI mode).
    """
    a = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
    shifted = lambda x, k: F.shiftleft((x * F.lit(k)).bitwiseAND(F.lit(0xFFFF)), 16)
    low = lo * F.lit(a[0]) + F.lit(1) + shifted(lo, a[1])
    carry = F.shiftright(low, 32) + F.shiftright(lo * F.lit(a[1]), 16)
    high = carry + lo * F.lit(a[2]) + shifted(lo, a[3]) + hi * F.lit(a[0]) + shifted(hi, a[1])
    return high.bitwiseAND(F.lit(LOW32)), low.bitwiseAND(F.lit(LOW32))


def _halves(key: Column) -> tuple[Column, Column]:
    key = key.cast("bigint")
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW32))


def jump_walk(key: Column, shards: int) -> Column:
    """struct(stop, next): the last stop below ``shards``, and the stop after it.

    The stop is the shard among ``shards``; with one shard more it is ``shards`` itself where
    ``next`` equals ``shards``, else unchanged. A walk to ``n`` takes ln(n) jumps on average
    and n at most, so n folds always reach the end. A NULL key walks like key 0.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    hi, lo = _halves(F.coalesce(key, F.lit(0)))

    def jump(state: Column, _: Column) -> Column:
        hi, lo = _next(state["hi"], state["lo"])
        reach = (state["next"] + 1) * F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1)
        return F.when(
            state["next"] < shards,
            F.struct(
                hi.alias("hi"), lo.alias("lo"), state["next"].alias("stop"),
                F.least(F.floor(reach), F.lit(1 << 31)).alias("next"),
            ),
        ).otherwise(state)

    start = F.struct(
        hi.alias("hi"), lo.alias("lo"), F.lit(0).cast("bigint").alias("stop"),
        F.lit(0).cast("bigint").alias("next"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(shards)), start, jump,
        lambda s: F.struct(s["stop"].cast("int").alias("stop"), s["next"].alias("next")),
    )


def shard_documents(
    docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document's shard among ``shards`` and among one more, with a gapless slot.

    Columns: the key, size (bytes of the text plus 8, 8 for a null text), text_crc32 (unsigned,
    of the UTF-8 bytes; a null text as empty), law (``key``: key and shard count decide), shard,
    slot, grown_shard. A null key walks like 0; equal rows get a slot each; an empty table gives
    no rows; other columns of ``docs`` are not read.

    Slots follow a block taken from the generator's first output, then key, size and checksum.
    Equal rows are counted before the shuffle and spread out again behind the slots, and a block
    is a task's work, so neither a hot key nor a full shard meets in one task.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = (
        docs.select(
            F.col(key).cast("bigint").alias("key"),
            (F.octet_length(raw).cast("bigint") + 8).alias("size"),
            F.crc32(raw).alias("text_crc32"),
        )
        .groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("walk", jump_walk(F.col("key"), shards))
        .withColumns({"shard": F.col("walk.stop"), "after": F.col("walk.next")}).drop("walk")
    )
    first, _ = _next(*_halves(F.coalesce(F.col("key"), F.lit(0))))
    placed = running_total(
        rows, F.col("copies"), ["key", "size", "text_crc32"], first % F.lit(BLOCKS), "base",
        ["shard"],
    )
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES}")))
    left = F.least(F.lit(COPIES), F.col("copies") - F.col("part") * COPIES)
    return (
        placed.select("*", part.alias("part"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), left - 1)).alias("one"))
        .select(
            F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("base") + F.col("part") * COPIES + F.col("one")).alias("slot"),
            F.when(F.col("after") == shards, F.lit(shards)).otherwise(F.col("shard"))
            .alias("grown_shard"),
        )
    )
