"""Fields read back out of log message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message formats of the sync, rejection and worker logs.
SYNC_PATTERN = r"sync (\S+) OK: read=(\d+) upserted=(\d+) duration_ms=(\d+)"
REJECT_PATTERN = r"HMAC inválido \((.*?)\) para event_type=(.*)$"
PROCESSED_WORDS = ("payment ", " procesado:")


def _group(message: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(message, pattern, group), F.lit(""))


def parse_sync_message(message: Column) -> Column:
    """Struct (process, rows_read, rows_upserted, duration_ms); all NULL for other messages."""
    return F.struct(
        _group(message, SYNC_PATTERN, 1).alias("process"),
        _group(message, SYNC_PATTERN, 2).try_cast("bigint").alias("rows_read"),
        _group(message, SYNC_PATTERN, 3).try_cast("bigint").alias("rows_upserted"),
        _group(message, SYNC_PATTERN, 4).try_cast("bigint").alias("duration_ms"),
    )


def parse_reject_message(message: Column) -> Column:
    """Struct (reason, event_type); both NULL for other messages."""
    return F.struct(
        _group(message, REJECT_PATTERN, 1).alias("reason"),
        _group(message, REJECT_PATTERN, 2).alias("event_type"),
    )


def is_processed_message(message: Column) -> Column:
    first, second = PROCESSED_WORDS
    return message.contains(first) & message.contains(second)
