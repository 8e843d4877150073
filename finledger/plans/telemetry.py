"""Reports over log messages, requests and gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.functions.messages import (
    is_processed_message,
    parse_reject_message,
    parse_sync_message,
)
from finledger.functions.scalars import bin_start
from finledger.operators.filters import within
from finledger.operators.ranking import exact_percentiles

ERROR_LEVEL = 3


def logs_of_service(logs: DataFrame, service: str, as_of, interval: str = "1 HOUR") -> DataFrame:
    return logs.where(within("timestamp", as_of, interval) & (F.col("service") == service)).orderBy(
        F.desc("timestamp")
    )


def errors_of_service(logs: DataFrame, service: str, as_of, interval: str = "24 HOURS") -> DataFrame:
    return logs_of_service(
        logs.where(F.col("severity_level") >= ERROR_LEVEL), service, as_of, interval
    )


def duration_by_process(logs: DataFrame, service: str, as_of, interval: str = "24 HOURS") -> DataFrame:
    """Average and longest sync duration per process, read back from the log text."""
    sync = parse_sync_message(F.col("message"))
    return (
        logs.where(within("timestamp", as_of, interval) & (F.col("service") == service))
        .select(sync.alias("s")).where(F.col("s.process").isNotNull())
        .groupBy(F.col("s.process").alias("process"))
        .agg(
            F.avg("s.duration_ms").alias("avg_duration_ms"),
            F.max("s.duration_ms").alias("max_duration_ms"),
            F.count(F.lit(1)).alias("runs"),
        )
        .orderBy(F.desc("avg_duration_ms"))
    )


def latency_percentiles(requests: DataFrame, as_of, interval: str = "24 HOURS",
                        width: str = "1 hour") -> DataFrame:
    """p50, p95, p99 and count per time bin, exact at any bin size."""
    rows = requests.where(within("timestamp", as_of, interval)).select(
        bin_start(F.col("timestamp"), width).alias("bin"), "duration"
    )
    return exact_percentiles(rows, ["bin"], "duration", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def status_codes(requests: DataFrame, as_of, interval: str = "24 HOURS", width: str = "1 hour") -> DataFrame:
    return (
        requests.where(within("timestamp", as_of, interval))
        .groupBy("result_code", bin_start(F.col("timestamp"), width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def rejects_by_reason(logs: DataFrame, service: str, as_of, interval: str = "24 HOURS") -> DataFrame:
    reject = parse_reject_message(F.col("message"))
    return (
        logs.where(within("timestamp", as_of, interval) & (F.col("service") == service))
        .select(reject["reason"].alias("reason")).where(F.col("reason").isNotNull())
        .groupBy("reason").agg(F.count(F.lit(1)).alias("rejects"))
        .orderBy(F.desc("rejects"))
    )


def processed_count(logs: DataFrame, service: str, as_of, interval: str = "24 HOURS") -> DataFrame:
    return logs.where(
        within("timestamp", as_of, interval) & (F.col("service") == service)
        & is_processed_message(F.col("message"))
    ).agg(F.count(F.lit(1)).alias("processed"))


def gauge_average(gauges: DataFrame, value: Column, as_of, interval: str = "1 HOUR",
                  width: str = "5 minutes") -> DataFrame:
    return (
        gauges.where(within("timestamp", as_of, interval))
        .groupBy(bin_start(F.col("timestamp"), width).alias("bin"))
        .agg(F.avg(value).alias("average"))
    )
