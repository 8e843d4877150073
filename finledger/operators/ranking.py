"""Positions and running sums over data of any size and skew.

A plain window puts a whole group, or the whole table, into one task. Here the order is
cut into *blocks* first: each block is summed on its own (with map-side combine), the
small list of block totals is accumulated, and the inside of a block is accumulated in
a task of its own. A block is any column that never decreases along the order, chosen
so that one block fits a task; group and block columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, amounts: dict[str, Column], order: Sequence[str | Column], block: Column,
    group: Sequence[str] = (),
) -> DataFrame:
    """Per output name the sum of its amount over the earlier rows of the group (this row
    excluded)."""
    group = list(group)
    df = df.withColumns({"__block": block, **{f"__{n}": a for n, a in amounts.items()}})
    totals = df.groupBy(*group, "__block").agg(
        *[F.sum(f"__{n}").alias(f"__total_{n}") for n in amounts]
    )
    earlier = Window.unboundedPreceding, -1
    across = Window.partitionBy(*group).orderBy("__block").rowsBetween(*earlier)
    within = Window.partitionBy(*group, "__block").orderBy(*order).rowsBetween(*earlier)
    offsets = totals.select(
        *group, "__block",
        *[F.coalesce(F.sum(f"__total_{n}").over(across), F.lit(0)).alias(f"__offset_{n}")
          for n in amounts],
    )
    inside = df.withColumns(
        {f"__inside_{n}": F.coalesce(F.sum(f"__{n}").over(within), F.lit(0)) for n in amounts}
    )
    joined = inside.join(offsets, [*group, "__block"])
    return joined.withColumns(
        {n: F.col(f"__offset_{n}") + F.col(f"__inside_{n}") for n in amounts}
    ).drop("__block", *[f"__{k}{n}" for n in amounts for k in ("", "offset_", "inside_")])


def running_total(
    df: DataFrame, amount: Column, order: Sequence[str | Column], block: Column,
    out: str = "before", group: Sequence[str] = (),
) -> DataFrame:
    return running_totals(df, {out: amount}, order, block, group)


def index_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], block: Column,
    out: str = "seq",
) -> DataFrame:
    """0-based position of each row in its group, in the given order."""
    return running_total(df, F.lit(1).cast("bigint"), order, block, out, group)


DIGIT = 16  # bits of a key that one round of the selection fixes


def ordered_key(value: Column) -> Column:
    """A double as a bigint that sorts like it (negative zero before zero, NaN last)."""
    bits = F.java_method(
        F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double")
    ).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def value_of_key(key: Column) -> Column:
    bits = F.when(key < 0, key.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(key)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double")


def select_ranks(rows: DataFrame, group: Sequence[str], key: str, asked: DataFrame) -> DataFrame:
    """The key at each asked 0-based rank of a group, exactly, by radix selection.

    ``asked`` has the group's columns and ``asked``, an array of (name, rank). Every round fixes the next
    16 bits of all ranks at once: rows under a prefix that is still asked for are counted per next digit
    (with map-side combine), and running counts over these at most 65,536 digits tell where a
    rank falls. No round moves more than the counts, however values are spread, and no values are
    sorted. Rows are read once per round. Group columns and keys must not be NULL. Columns: the
    group's, name, and the key.
    """
    group = list(group)
    asked = asked.select(*group, F.lit(0).cast("bigint").alias("__prefix"), "asked")
    for shift in range(64 - DIGIT, -1, -DIGIT):
        above = F.shiftright(key, shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("bigint")
        under = rows.select(*group, above.alias("__prefix"), F.shiftright(key, shift).alias("__next"))
        counts = under.join(asked, [*group, "__prefix"]).groupBy(
            *group, "__prefix", "asked", "__next"  # the array goes with the prefix
        ).agg(F.count(F.lit(1)).alias("__n"))
        earlier = Window.partitionBy(*group, "__prefix").orderBy("__next").rowsBetween(
            Window.unboundedPreceding, -1
        )
        counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        rank = F.col("a.rank")
        found = counts.select("*", F.explode("asked").alias("a")).where(
            (rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__n"))
        ).select(
            *group, F.col("__next").alias("__prefix"),
            F.struct(F.col("a.name").alias("name"), (rank - F.col("__before")).alias("rank")).alias("a"),
        )
        asked = found.groupBy(*group, "__prefix").agg(F.collect_list("a").alias("asked"))
    return found.select(*group, "a.name", F.col("__prefix").alias(key))


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float], count_as: str = "count",
) -> DataFrame:
    """Interpolated percentiles per group, exact, however values and groups are skewed.

    The two ranks around each percentile are found by ``select_ranks``; NULL values do not
    count.
    """
    group = list(group)
    rows = df.where(F.col(value).isNotNull()).select(*group, ordered_key(F.col(value)).alias("__key"))
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias(count_as))
    at = {name: (F.col(count_as) - 1) * F.lit(float(p)) for name, p in probs.items()}
    asked = F.array(*[
        F.struct(F.lit(f"{name}_{side}").alias("name"), rank(place).cast("bigint").alias("rank"))
        for name, place in at.items() for side, rank in (("lo", F.floor), ("hi", F.ceil))
    ])
    found = select_ranks(rows, group, "__key", sizes.select(*group, asked.alias("asked")))
    found = found.groupBy(*group).agg(*[
        F.max(F.when(F.col("name") == f"{name}_{side}", F.col("__key"))).alias(f"__{name}_{side}")
        for name in probs for side in ("lo", "hi")
    ])
    ends = [c for c in found.columns if c not in group]
    found = found.select(*group, *[value_of_key(F.col(c)).alias(c) for c in ends])
    out = []
    for name, place in at.items():
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        # equal ends stay as they are, infinite ones too
        out.append(F.when(lo == hi, lo).otherwise(lo + (place - F.floor(place)) * (hi - lo)).alias(name))
    return found.join(sizes, group).select(*group, *out, count_as)
