"""Cutting a time range so that no piece is larger than a cap."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger.operators.ranking import running_total, running_totals
from finledger.session import written


def _instants(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull()).groupBy(ts).agg(F.count(F.lit(1)).alias("n"))


def plan_slices(df: DataFrame, ts: str, cap: int, block_unit: str = "day") -> DataFrame:
    """Consecutive time slices [begin, end], none above ``cap`` rows, no instant split.

    Instants are counted first. Those above half the cap get a slice of their own, the
    others are packed by running count into halves of the cap, so a slice of them stays
    below the cap. A single instant above the cap cannot be cut: it is marked
    ``overfull``. Rows without a time are one row without bounds. ``block_unit`` is the stretch of time ranked in one task.
    """
    half = max(cap // 2, 1)
    counts = _instants(df, ts)
    heavy = F.col("n") > half
    counts = counts.withColumns(
        {"heavy": heavy.cast("bigint"), "light": F.when(heavy, 0).otherwise(F.col("n"))}
    )
    block = F.date_trunc(block_unit, F.col(ts))
    ranked = running_totals(
        counts, {"light_before": F.col("light"), "heavy_before": F.col("heavy")}, [ts], block
    )
    packed = F.floor(F.col("light_before") / half)
    undated = df.where(F.col(ts).isNull()).agg(
        F.min(ts).alias("begin_ts"), F.max(ts).alias("end_ts"), F.count(F.lit(1)).alias("rows"),
        F.lit(False).alias("overfull"),
    ).where("rows > 0")
    return (
        ranked.groupBy(
            "heavy_before", "heavy", F.when(F.col("heavy") == 0, packed).otherwise(-1).alias("pack")
        )
        .agg(F.min(ts).alias("begin_ts"), F.max(ts).alias("end_ts"), F.sum("n").alias("rows"))
        .select("begin_ts", "end_ts", "rows", (F.col("rows") > cap).alias("overfull"))
        .unionByName(undated)
    )


def _cuts(counts: DataFrame, ts: str, cap: int) -> DataFrame:
    """Per instant (ts, n, before) the instant in which a slice of ``cap`` rows from it ends.

    That is the last instant with at most ``cap - 1`` rows more in front of it. Instants and their ends
    are laid out by row number and cut into stretches of ``cap`` rows; inside a stretch the last
    instant is looked up on its own, and the last one of the stretches before comes from the
    short list of stretches.
    """
    block = F.floor(F.col("at") / cap)
    places = counts.select(F.col("before").alias("at"), F.col(ts).alias("here"), F.lit(None).cast(counts.schema[ts].dataType).alias(ts))
    ends = counts.select((F.col("before") + cap - 1).alias("at"), F.lit(None).cast(counts.schema[ts].dataType).alias("here"), ts)
    both = places.unionByName(ends).withColumn("block", block)
    last = both.groupBy("block").agg(F.max("here").alias("last"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("block", F.max("last").over(earlier).alias("last"))
    # at the same row number the instant comes before the end that looks for it
    inside = Window.partitionBy("block").orderBy("at", F.col("here").isNull())
    found = both.withColumn("inside", F.max("here").over(inside)).where(F.col(ts).isNotNull())
    return found.join(last, "block").select(ts, F.coalesce("inside", "last").alias("end_ts"))


def cursor_slices(df: DataFrame, ts: str, cap: int, block_unit: str = "day") -> DataFrame:
    """The slices of a sequential cursor, all at once: begin_ts, end_ts, rows, overfull.

    The cursor reads on from an instant, oldest first, up to ``cap`` rows, and goes on at the last
    instant it has seen, whose rows it reads again as it may have been cut. Where that is the instant
    it began at, it cannot move: the slice is ``overfull`` if the instant has more rows than
    the cap, and the cursor goes on behind it. ``rows`` is what a slice reads.

    Where a slice from any instant would end follows from running counts. The instants that the cursor
    really reaches are found by pointer doubling: every round doubles the length of all jumps
    and adds what the instants reached so far jump to, so the rounds are the logarithm of
    the number of slices. Rows without a time are in no slice.
    """
    counts = running_total(
        _instants(df, ts), F.col("n"), [ts], F.date_trunc(block_unit, F.col(ts)), "before"
    )
    counts = written(counts.select(ts, "n", "before"), "instants")
    top = counts.agg(F.sum("n").alias("rows"), F.max(ts).alias("last")).first()
    total, last = top["rows"] or 0, F.lit(top["last"]).cast(df.schema[ts].dataType)
    following = counts.select(F.col("before").alias("after"), F.col(ts).alias("following"))
    drained = F.col("before") + cap >= total
    steps = counts.withColumn("after", F.col("before") + F.col("n")).join(following, "after", "left").join(
        _cuts(counts, ts, cap), ts
    ).select(
        ts, F.when(drained, last).otherwise(F.col("end_ts")).alias("end_ts"),
        F.least(F.lit(cap), F.lit(total) - F.col("before")).cast("bigint").alias("rows"),
        (~drained & (F.col("n") > cap)).alias("overfull"),
        F.when(~drained, F.when(F.col("end_ts") > F.col(ts), F.col("end_ts")).otherwise(F.col("following")))
        .alias("next"),
    )
    steps = written(steps, "steps")
    jumps = steps.where("next IS NOT NULL").select(F.col(ts).alias("from"), F.col("next").alias("to"))
    reached = written(counts.where("before = 0").select(F.col(ts).alias("at")), "reached")
    known = reached.count()
    while True:
        more = reached.join(jumps, reached["at"] == jumps["from"]).select(F.col("to").alias("at"))
        reached = written(reached.union(more), "reached")
        now = reached.count()
        if now == known:
            break
        known = now
        ahead = jumps.select(F.col("from").alias("to"), F.col("to").alias("further"))
        jumps = written(jumps.join(ahead, "to").select("from", F.col("further").alias("to")), "jumps")
    return steps.join(reached, steps[ts] == reached["at"], "left_semi").select(
        F.col(ts).alias("begin_ts"), "end_ts", "rows", "overfull"
    )


def cap_cycle(
    df: DataFrame, ts: str, key: str, cap: int | None = None, block_unit: str = "day",
    after: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All rows, or at most ``cap`` of them, oldest first, and from where to carry on.

    ``after`` is the watermark of the cycle before (struct of time and key): only later rows are
    taken, so cycles that follow each other take every row once. Running counts per instant show
    where the cap falls, so only the rows up to there are sorted. The second result is one row: time
    and key of the last row taken, how many rows are left over, and how many were skipped as they
    have no key or no time.
    """
    fit = F.col(key).isNotNull() & F.col(ts).isNotNull()
    rows = df.where(fit)
    if after is not None:
        rows = rows.where(F.struct(F.col(ts), F.col(key)) > after)
    skipped = df.where(~fit).agg(F.count(F.lit(1)).alias("skipped"))
    taken = rows
    if cap is not None:
        counts = running_total(
            _instants(rows, ts), F.col("n"), [ts], F.date_trunc(block_unit, F.col(ts)), "before"
        )
        reached = counts.where(F.col("before") < cap)
        near = rows.join(reached.select(ts), ts, "left_semi")
        taken = near.orderBy(F.asc(ts), F.asc(key)).limit(cap)
    last = taken.agg(
        F.max(F.struct(F.col(ts).alias("ts"), F.col(key).alias("key"))).alias("last"),
        F.count(F.lit(1)).alias("taken"),
    )
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    carry = last.join(total).join(skipped).select(
        F.col("last.ts").alias("carry_over_from"), F.col("last.key").alias("carry_over_key"),
        (F.col("total") - F.col("taken")).alias("left_over"), "skipped",
    )
    return taken, carry


def cycles(df: DataFrame, ts: str, key: str, cap: int, block_unit: str = "day") -> Iterator[DataFrame]:
    """Cycle after cycle of at most ``cap`` rows until none is left over; each starts behind the
    watermark of the one before."""
    after = None
    while True:
        taken, carry = cap_cycle(df, ts, key, cap, block_unit, after)
        state = carry.first()
        if state["carry_over_from"] is None:
            return
        yield taken
        if not state["left_over"]:
            return
        after = F.struct(F.lit(state["carry_over_from"]).cast(df.schema[ts].dataType),
                         F.lit(state["carry_over_key"]).cast(df.schema[key].dataType))
