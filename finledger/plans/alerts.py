"""Threshold and absence alerts over event time, as batch plans.

Events are reduced to tumbling bins first (with map-side combine); only bins enter
overlapping windows or are put in order, so a busy source costs no more than a quiet one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Threshold:
    """Alert when ``agg`` of the value over ``window`` exceeds ``limit``, every ``every``."""

    window: str
    every: str
    agg: str  # count, sum, max or avg
    limit: float


# The alert rules in use.
SERVER_ERRORS = Threshold("5 minutes", "1 minute", "count", 5)
QUEUE_BACKLOG = Threshold("15 minutes", "5 minutes", "max", 100)
CPU_LOAD = Threshold("15 minutes", "5 minutes", "avg", 80)
RUN_GAP_MINUTES = 30


def _finish(agg: str) -> Column:
    return {
        "count": F.sum("__n"),
        "sum": F.sum("__sum"),
        "max": F.max("__max"),
        "avg": F.sum("__sum") / F.sum("__n"),
    }[agg]


def sliding_aggregate(df: DataFrame, ts: str, rule: Threshold, value: Column | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """The rule's aggregate for every window position that holds an event."""
    value = F.lit(1) if value is None else value
    bins = df.groupBy(*by, F.window(ts, rule.every).getField("start").alias("__bin")).agg(
        F.count(value).alias("__n"), F.sum(value).alias("__sum"), F.max(value).alias("__max")
    )
    return (
        bins.groupBy(*by, F.window("__bin", rule.window, rule.every).alias("w"))
        .agg(_finish(rule.agg).alias("value"))
        .select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "value")
    )


def threshold_alert(df: DataFrame, ts: str, rule: Threshold, value: Column | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    return sliding_aggregate(df, ts, rule, value, by).where(F.col("value") > rule.limit)


def absence_alert(df: DataFrame, key: str, ts: str, gap_minutes: int = RUN_GAP_MINUTES,
                  bin_minutes: int | None = None, as_of: Column | None = None,
                  expected: DataFrame | None = None) -> DataFrame:
    """Stretches longer than the gap without a run, per key.

    Only first and last run of each bin are kept; bins are no wider than the gap, so a gap lies
    between two neighbouring bins. With ``as_of`` the stretch that lasts until then counts as
    well (its ``gap_end`` is ``as_of``), and a key of ``expected`` that never ran has no
    ``gap_start``.
    """
    bin_minutes = bin_minutes or gap_minutes
    if bin_minutes > gap_minutes:
        raise ValueError("bins must not be wider than the gap")
    if as_of is not None:
        df = df.where(F.col(ts) <= as_of)
    bins = df.groupBy(key, F.window(ts, f"{bin_minutes} minutes").getField("start").alias("bin")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    following = F.lead("first_ts").over(Window.partitionBy(key).orderBy("bin"))
    end = F.coalesce(following, as_of) if as_of is not None else following
    out = (
        bins.withColumn("next_ts", end)
        .where(F.col("next_ts") > F.col("last_ts") + F.expr(f"INTERVAL {gap_minutes} MINUTES"))
        .select(key, F.col("last_ts").alias("gap_start"), F.col("next_ts").alias("gap_end"),
                F.timestamp_diff("SECOND", F.col("last_ts"), F.col("next_ts")).alias("gap_seconds"))
    )
    if as_of is None or expected is None:
        return out
    never = expected.select(key).distinct().join(df.select(key), key, "left_anti").select(
        key, F.lit(None).cast("timestamp_ntz").alias("gap_start"), as_of.alias("gap_end"),
        F.lit(None).cast("bigint").alias("gap_seconds"),
    )
    return out.unionByName(never)
