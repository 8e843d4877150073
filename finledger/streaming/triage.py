"""Signed notifications: accept, ignore or reject each with a reason. Stateless, so the
same plan serves a batch and a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.functions import signed

EVENT_DDL = "body STRING, x_signature STRING, x_request_id STRING, received_at TIMESTAMP_NTZ"


def received_millis(received_at: Column) -> Column:
    return F.unix_millis(received_at.cast("timestamp"))


def _read(events: DataFrame) -> DataFrame:
    body = F.coalesce(F.nullif(F.col("body"), F.lit("")), F.lit("{}"))
    events = events.withColumn("__v", F.try_parse_json(body))
    is_object = F.try_variant_get("__v", "$", "map<string,variant>").isNotNull()
    return events.withColumns(
        {
            "__ok_json": is_object,
            "data_id": signed.event_data_id(F.col("__v")),
            "event_type": signed.event_type(F.col("__v")),
        }
    ).withColumn(
        "__age",
        signed.classify_age(F.col("x_signature"), F.col("x_request_id"), F.col("data_id"),
                            received_millis(F.col("received_at"))),
    )


def _verdict(rows: DataFrame, reason: Column) -> DataFrame:
    """Status in the order of the checks: body, signature, type, id."""
    payment = F.col("event_type") == "payment"
    status = (
        F.when(~F.col("__ok_json"), 400)
        .when(reason != "ok", 401)
        .when(~payment, 200)
        .when(F.col("data_id") == "", 400)
        .otherwise(202)
    )
    why = (
        F.when(~F.col("__ok_json"), "invalid_json")
        .when(reason != "ok", reason)
        .when(~payment, "ignored")
        .when(F.col("data_id") == "", "missing_payment_id")
        .otherwise("accepted")
    )
    return rows.withColumns({"status_code": status, "reason": why})


def triage_unsigned(events: DataFrame) -> DataFrame:
    """Every check but the signature itself."""
    rows = _read(events)
    return _verdict(rows, F.col("__age")).drop("__v", "__ok_json", "__age")


def triage_events(events: DataFrame, secret: str) -> DataFrame:
    """All checks. Only rows that passed the others are signed and compared."""
    rows = _read(events)
    sig = signed.parse_signature(F.col("x_signature"))
    text = F.when(
        F.col("__ok_json") & (F.col("__age") == "ok"),
        signed.manifest(F.col("data_id"), F.col("x_request_id"), sig["ts"]),
    )
    rows = rows.withColumn("__expected", signed.sign_with(secret)(text))
    same = F.col("__expected").eqNullSafe(sig["v1"])
    reason = F.when((F.col("__age") == "ok") & ~same, "hmac_mismatch").otherwise(F.col("__age"))
    return _verdict(rows, reason).drop("__v", "__ok_json", "__age", "__expected")


def payment_ids(triaged: DataFrame) -> DataFrame:
    """What goes on to the payment worker."""
    return triaged.where(F.col("status_code") == 202).select(
        F.col("data_id").alias("payment_id"), "received_at"
    )
