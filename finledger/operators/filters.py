"""Row filters that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Movement feeds, and the defaults of a movement request.
MOVEMENT_KINDS = ("anteriores", "dia", "diferidos", "zughus")
DEFAULT_ACCOUNT_TYPE = "CC"
DEFAULT_CURRENCY = "ARS"


def search_payments(
    df: DataFrame, begin, end, field: str = "date_last_updated", status: str | None = None,
    descending: bool = True, limit: int | None = None, offset: int = 0, key: str = "payment_id",
) -> DataFrame:
    """Payments in the closed range, optionally of one status, sorted and paged."""
    out = df.where((F.col(field) >= begin) & up_to(field, end))
    if status:
        out = out.where(F.col("status") == status)
    if limit is None and not offset:
        return out
    order = [F.desc(field), F.desc(key)] if descending else [F.asc(field), F.asc(key)]
    out = out.orderBy(*order)
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)


def up_to(col: str, end) -> Column:
    """At or before the end of a closed range; a date (or its text) ends with its last instant."""
    try:
        day = isinstance(end, dt.date) and not isinstance(end, dt.datetime) or isinstance(end, str) \
            and dt.date.fromisoformat(end) is not None
    except ValueError:
        day = False
    if not day:
        return F.col(col) <= end
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end
    return F.col(col) < F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz")


def request_filter(
    df: DataFrame, kind: str = "anteriores", account_type: str = DEFAULT_ACCOUNT_TYPE,
    currency: str = DEFAULT_CURRENCY, begin=None, end=None, date_col: str = "process_date",
) -> DataFrame:
    """Rows of one movement request; the same-day feed ignores the date window."""
    if kind not in MOVEMENT_KINDS:
        raise ValueError(f"unknown movement kind {kind!r}")
    out = df.where(
        (F.col("movement_type") == kind) & (F.col("account_type") == account_type)
        & (F.col("currency") == currency)
    )
    if kind != "dia":
        if begin is not None:
            out = out.where(F.col(date_col) >= begin)
        if end is not None:
            out = out.where(up_to(date_col, end))
    return out


def account_subset(df: DataFrame, accounts: DataFrame | Sequence[str], col: str = "account_number") -> DataFrame:
    """Rows of the given accounts: a literal list, or a table of any size."""
    if isinstance(accounts, DataFrame):
        return df.join(accounts.select(col), col, "left_semi")
    return df.where(F.col(col).isin(list(accounts)))


def current_only(col: str = "is_historical") -> Column:
    return ~F.coalesce(F.col(col), F.lit(False))


def historical_only(col: str = "is_historical") -> Column:
    return F.coalesce(F.col(col), F.lit(False))


def settled_only(col: str = "movement_source") -> Column:
    """Everything but same-day rows; rows without a source count as settled."""
    return ~F.col(col).eqNullSafe(F.lit("dia"))


def within(col: str, as_of, interval: str) -> Column:
    """Strictly newer than ``as_of`` minus the interval."""
    return F.col(col) > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")


def date_preset(preset: str, as_of: dt.date, begin: dt.date | None = None,
                end: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Closed date range of a preset: ``7d``, ``30d``, ``month`` or ``custom``."""
    if preset == "custom":
        if begin is None or end is None or begin > end:
            raise ValueError("a custom range needs begin <= end")
        return begin, end
    if preset == "month":
        return as_of.replace(day=1), as_of
    days = {"7d": 7, "30d": 30}[preset]
    return as_of - dt.timedelta(days=days), as_of


def in_preset(df: DataFrame, col: str, preset: str, as_of: dt.date, **custom) -> DataFrame:
    begin, end = date_preset(preset, as_of, **custom)
    return df.where((F.col(col) >= F.lit(begin)) & (F.col(col) < F.lit(end + dt.timedelta(days=1))))
