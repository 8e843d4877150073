"""One row per key.

Built on max_by / min_by: every map task reduces its rows to one per key before the
shuffle, so a key that holds much of the data costs no more than any other.
The ordinal must be free of ties for the choice to be reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(choose: str, df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    rest = [f"`{c}`" for c in df.columns if c not in keys]
    order = [f"`{c}`" for c in ordinal]
    row = F.expr(f"{choose}(struct({', '.join(rest)}), struct({', '.join(order)}))")
    picked = df.groupBy(*keys).agg(row.alias("__row"))
    return picked.selectExpr(
        *[f"`{c}`" if c in keys else f"__row.`{c}` AS `{c}`" for c in df.columns]
    )


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """The latest row of each key: a later delivery replaces an earlier one."""
    return _pick("max_by", df, keys, ordinal)


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """The earliest row of each key: re-read rows of overlapping windows collapse."""
    return _pick("min_by", df, keys, ordinal)


def latest_per(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    return keep_last(df, [key], [ts, tiebreak])
