"""Signed payment notifications: header parsing, age check and signature."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from finledger.functions.scalars import first_nonblank, strip

MAX_AGE_SECONDS = 300


def _part(header: Column, name: str) -> Column:
    # the greedy prefix keeps the last occurrence when a key is repeated
    return strip(F.regexp_extract(header, rf"^(?:.*,)?\s*{name}\s*=([^,]*)", 1))


def parse_signature(header: Column) -> Column:
    """Struct (ts, v1) from ``ts=…,v1=…`` in any order, spaces allowed; missing is NULL."""
    return F.struct(
        F.nullif(_part(header, "ts"), F.lit("")).alias("ts"),
        F.nullif(_part(header, "v1"), F.lit("")).alias("v1"),
    )


def manifest(data_id: Column, request_id: Column, ts: Column) -> Column:
    return F.concat(
        F.lit("id:"), data_id, F.lit(";request-id:"), request_id, F.lit(";ts:"), ts, F.lit(";")
    )


def event_type(v: Column) -> Column:
    """``type``, else ``topic``, else empty."""
    return first_nonblank(
        F.try_variant_get(v, "$.type", "string"), F.try_variant_get(v, "$.topic", "string")
    )


def event_data_id(v: Column) -> Column:
    """``data.id``, else ``id``, else empty; zero counts as missing."""
    return first_nonblank(
        F.nullif(F.try_variant_get(v, "$.data.id", "string"), F.lit("0")),
        F.nullif(F.try_variant_get(v, "$.id", "string"), F.lit("0")),
    )


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def classify_age(
    header: Column,
    request_id: Column,
    data_id: Column,
    received_ms: Column,
    max_age_s: int = MAX_AGE_SECONDS,
) -> Column:
    """Reason text of every check that needs no secret, ``ok`` when all pass.

    ``received_ms`` is the arrival time in epoch milliseconds, so the verdict
    can be recomputed later from landed rows.
    """
    sig = parse_signature(header)
    sent = sig["ts"].try_cast("bigint")
    age = (received_ms - sent) / F.lit(1000.0)
    whole = age.cast("bigint").cast("string")
    return (
        F.when(_blank(header), "missing_x_signature")
        .when(_blank(request_id), "missing_x_request_id")
        .when(_blank(data_id), "missing_data_id")
        .when(sig["ts"].isNull() | sig["v1"].isNull(), "malformed_x_signature")
        .when(sent.isNull(), "ts_not_integer")
        .when(age > max_age_s, F.concat(F.lit("ts_too_old("), whole, F.lit("s)")))
        .when(age < -max_age_s, F.concat(F.lit("ts_in_future("), whole, F.lit("s)")))
        .otherwise("ok")
    )


def sign_with(secret: str):
    """Arrow UDF: hex HMAC-SHA256 of the manifest text. The secret stays in the closure
    and never shows up in a plan."""
    key = secret.encode("utf-8")

    @F.pandas_udf("string")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(
                lambda t: None if t is None
                else hmac.new(key, t.encode("utf-8"), hashlib.sha256).hexdigest()
            )

    return sign
