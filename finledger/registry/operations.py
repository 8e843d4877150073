"""Queries on run ledger, control rows, logs, requests, alerts and signed notifications."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from finledger.functions import signed
from finledger.functions.messages import parse_reject_message, parse_sync_message
from finledger.functions.scalars import with_service
from finledger.operators import control as C
from finledger.operators import slices
from finledger.plans import alerts, reports, telemetry
from finledger.registry import standins as S
from finledger.registry.core import Data, query
from finledger.streaming import triage

AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


# -- run ledger and control -----------------------------------------------------
@query(f"""
SELECT sync_run_id, source_system, process_name, started_at, finished_at, status, rows_read,
       rows_upserted, CAST(NULL AS BIGINT) AS rows_deleted_reloaded, error_message
FROM ({S.SQL_RUNS})
""")
def run_ledger_fold(d: Data):
    """Start and finish events folded to one row per run."""
    start = """named_struct('event', 'RUNNING', 'at', started_at, 'rows_read', CAST(NULL AS BIGINT),
        'rows_upserted', CAST(NULL AS BIGINT), 'error_message', CAST(NULL AS STRING))"""
    finish = """named_struct('event', status, 'at', finished_at, 'rows_read', rows_read,
        'rows_upserted', rows_upserted, 'error_message', error_message)"""
    ledger = S.runs(d.events).selectExpr(
        "sync_run_id AS run_id", "source_system", "process_name",
        f"explode(if(status = 'RUNNING', array({start}), array({start}, {finish}))) AS e",
    ).selectExpr("run_id", "source_system", "process_name", "e.*",
                 "CAST(NULL AS BIGINT) AS rows_deleted_reloaded")
    return C.fold_runs(ledger)


@query(f"""
SELECT sync_run_id, source_system, process_name, started_at, status FROM ({S.SQL_RUNS})
ORDER BY started_at DESC, sync_run_id DESC LIMIT 10
""")
def latest_runs(d: Data):
    rows = S.runs(d.events).select("sync_run_id", "source_system", "process_name", "started_at", "status")
    return reports.latest_runs(rows)


@query(f"""
SELECT sync_run_id, source_system, process_name, started_at, status FROM ({S.SQL_RUNS})
WHERE source_system = 'IB' ORDER BY started_at DESC, sync_run_id DESC LIMIT 20
""")
def latest_bank_runs(d: Data):
    rows = S.runs(d.events).select("sync_run_id", "source_system", "process_name", "started_at", "status")
    return reports.latest_runs(rows, 20, "IB")


@query(f"""
SELECT sync_run_id, process_name, started_at, finished_at, status, error_message FROM ({S.SQL_RUNS})
WHERE status = 'ERROR' ORDER BY started_at DESC, sync_run_id DESC LIMIT 20
""")
def recent_errors(d: Data):
    return reports.recent_errors(S.runs(d.events))


@query(f"""
SELECT process_name, started_at, finished_at, status,
       date_diff('second', started_at, finished_at) AS duration_sec
FROM ({S.SQL_RUNS}) WHERE source_system = 'IB'
""")
def run_durations(d: Data):
    return reports.run_durations(S.runs(d.events), "IB")


@query(f"""
SELECT process_name, started_at, sync_run_id, status, rows_upserted, error_message FROM
  (SELECT *, row_number() OVER (PARTITION BY process_name ORDER BY started_at DESC, sync_run_id DESC) AS rn
   FROM ({S.SQL_RUNS})) WHERE rn = 1
""")
def last_run_per_process(d: Data):
    return reports.last_run_per_process(S.runs(d.events))


@query(f"""
SELECT process_name, last_status, last_successful_sync, last_error FROM ({S.SQL_CONTROL})
WHERE starts_with(process_name, 'job_')
""")
def control_status(d: Data):
    return reports.control_status(S.control(d.events), "job_")


@query(f"""
SELECT process_name, last_status, last_successful_sync,
       date_diff('minute', last_successful_sync, {AS_OF_SQL}) AS minutes_since_last_success
FROM ({S.SQL_CONTROL})
""")
def minutes_since_success(d: Data):
    return reports.minutes_since_success(S.control(d.events), AS_OF)


@query(f"SELECT max(last_successful_sync) AS last_successful_sync FROM ({S.SQL_CONTROL})")
def last_success(d: Data):
    return reports.last_success(S.control(d.events), "job_")


@query(f"""
SELECT process_name, CAST(coalesce(last_successful_sync, {AS_OF_SQL}) AS DATE) - 7 AS begin_date,
       CAST({AS_OF_SQL} AS DATE) AS end_date
FROM ({S.SQL_CONTROL})
""")
def window_bounds(d: Data):
    return C.window_bounds(S.control(d.events), S.lit_ts(AS_OF))


@query(f"""
SELECT 'incremental' AS window_name, count(*) AS rows FROM events WHERE ts BETWEEN {AS_OF_SQL} - INTERVAL 4 HOUR AND {AS_OF_SQL}
UNION ALL
SELECT 'initial', count(*) FROM events WHERE ts BETWEEN {AS_OF_SQL} - INTERVAL 365 DAY AND {AS_OF_SQL}
UNION ALL
SELECT 'process', count(*) FROM events WHERE ts >= (SELECT CAST(last_successful_sync AS DATE) - 7 FROM ({S.SQL_CONTROL}) WHERE process_name = 'job_view')
""")
def window_rows(d: Data):
    """Rows inside the windows a cycle would read."""
    now = dt.datetime(2024, 1, 31)
    begin, _ = C.window_for(S.control(d.events), "job_view", now)
    parts = []
    for name, (lo, hi) in {
        "incremental": C.rolling_window(now), "initial": C.rolling_window(now, initial_days=365),
        "process": (begin, None),
    }.items():
        rows = d.events.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        rows = rows if hi is None else rows.where(F.col("ts") <= F.lit(hi).cast("timestamp_ntz"))
        parts.append(rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("window_name"), "rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""
SELECT process_name, source_system,
       CASE WHEN process_name IN ('job_view', 'job_click') THEN {AS_OF_SQL} ELSE last_successful_sync END AS last_successful_sync,
       CASE WHEN process_name = 'job_signup' THEN last_attempt_sync ELSE {AS_OF_SQL} END AS last_attempt_sync,
       CASE WHEN process_name = 'job_signup' THEN last_status
            WHEN process_name IN ('job_view', 'job_click') THEN 'SUCCESS' ELSE 'ERROR' END AS last_status,
       CASE WHEN process_name = 'job_signup' THEN last_error
            WHEN process_name IN ('job_view', 'job_click') THEN NULL ELSE 'boom' END AS last_error,
       CASE WHEN process_name <> 'job_signup' THEN {AS_OF_SQL} - INTERVAL 7 DAY END AS last_begin_date_used
FROM ({S.SQL_CONTROL})
""")
def control_advance(d: Data):
    """Two processes succeed, two fail, one does not run."""
    control = S.control(d.events)
    name = F.col("process_name")
    outcomes = control.where(name != "job_signup").select(
        "process_name", name.isin("job_view", "job_click").alias("ok"),
        (S.lit_ts(AS_OF) - F.expr("INTERVAL 7 DAYS")).alias("begin_date"),
        S.lit_ts(AS_OF).alias("end_date"), S.lit_ts(AS_OF).alias("at"), F.lit("boom").alias("error"),
    )
    return C.advance_control(control, outcomes).select(
        "process_name", "source_system", "last_successful_sync", "last_attempt_sync", "last_status",
        "last_error", "last_begin_date_used",
    )


@query(f"""
SELECT event_type AS step, count(*) AS rows_read, count(*) FILTER (WHERE {S.SQL_K} >= 5) AS rows_upserted,
       count(*) FILTER (WHERE {S.SQL_K} < 5) AS failures,
       CASE WHEN count(*) FILTER (WHERE {S.SQL_K} < 5) > 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status
FROM events GROUP BY 1
""")
def error_split(d: Data):
    """Failed requests become rows of their own; a step with one of them ends as ERROR."""
    error = F.when(S.k() < 5, F.concat(F.lit("request failed: "), S.k()))
    return C.step_status(d.events.withColumn("step", F.col("event_type")), error, ["step"])


@query(f"""
SELECT event_id, 'request failed: ' || {S.SQL_K} AS error FROM events WHERE {S.SQL_K} < 5
""")
def failed_requests(d: Data):
    error = F.when(S.k() < 5, F.concat(F.lit("request failed: "), S.k()))
    _, bad = C.split_errors(d.events, error, keep=["event_id"])
    return bad


# -- slices ----------------------------------------------------------------------
@query("""
SELECT o_orderkey AS payment_id, CAST(o_orderdate AS TIMESTAMP) AS date_last_updated FROM orders
ORDER BY o_orderdate, o_orderkey LIMIT 10000
""")
def cap_cycle(d: Data):
    rows = S.payments(d.orders).select("payment_id", "date_last_updated")
    taken, _ = slices.cap_cycle(rows, "date_last_updated", "payment_id", 10000, "month")
    return taken


@query("""
WITH c AS (SELECT o_orderdate AS ts, count(*) AS n FROM orders GROUP BY 1),
     r AS (SELECT ts, n, sum(n) OVER (ORDER BY ts) - n AS before FROM c)
SELECT CAST(max(ts) FILTER (WHERE before < 10000) AS TIMESTAMP) AS carry_over_from,
       (SELECT max(o_orderkey) FROM (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10000)
        WHERE o_orderdate = (SELECT max(ts) FILTER (WHERE before < 10000) FROM r)) AS carry_over_key,
       CAST(greatest(sum(n) - 10000, 0) AS BIGINT) AS left_over, CAST(0 AS BIGINT) AS skipped FROM r
""")
def cap_carry_over(d: Data):
    rows = S.payments(d.orders).select("payment_id", "date_last_updated")
    _, carry = slices.cap_cycle(rows, "date_last_updated", "payment_id", 10000, "month")
    return carry


@query("""
WITH c AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, count(*) AS n FROM lineitem GROUP BY 1),
     h AS (SELECT ts, n, CAST(n > 100 AS BIGINT) AS heavy, CASE WHEN n > 100 THEN 0 ELSE n END AS light FROM c),
     r AS (SELECT *, sum(light) OVER (ORDER BY ts) - light AS lb, sum(heavy) OVER (ORDER BY ts) - heavy AS hb FROM h)
SELECT min(ts) AS begin_ts, max(ts) AS end_ts, CAST(sum(n) AS BIGINT) AS rows, sum(n) > 200 AS overfull
FROM r GROUP BY hb, heavy, CASE WHEN heavy = 0 THEN lb // 100 ELSE -1 END
""")
def plan_slices(d: Data):
    rows = d.lineitem.select(F.col("l_shipdate").cast("timestamp_ntz").alias("ts"))
    return slices.plan_slices(rows, "ts", 200, "month")


@query("""
WITH RECURSIVE c AS (SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, count(*) AS n FROM lineitem GROUP BY 1),
     r AS (SELECT ts, n, sum(n) OVER (ORDER BY ts) - n AS before, sum(n) OVER () AS total,
                  lead(ts) OVER (ORDER BY ts) AS following, max(ts) OVER () AS final FROM c),
     s AS (SELECT a.*, b.ts AS cut, a.before + 200 >= a.total AS drained
           FROM r a ASOF JOIN r b ON a.before + 199 >= b.before),
     w AS (SELECT min(ts) AS ts FROM r
           UNION ALL SELECT CASE WHEN s.cut > s.ts THEN s.cut ELSE s.following END
           FROM w JOIN s ON w.ts = s.ts WHERE NOT s.drained AND (s.cut > s.ts OR s.following IS NOT NULL))
SELECT s.ts AS begin_ts, CASE WHEN drained THEN final ELSE cut END AS end_ts,
       CAST(least(200, total - before) AS BIGINT) AS rows, NOT drained AND n > 200 AS overfull
FROM w JOIN s ON w.ts = s.ts
""")
def cursor_slices(d: Data):
    """The slices that a cursor would take one after the other, found all at once."""
    rows = d.lineitem.select(F.col("l_shipdate").cast("timestamp_ntz").alias("ts"))
    return slices.cursor_slices(rows, "ts", 200, "month")


# -- logs and requests ---------------------------------------------------------------
@query(f"""
SELECT event_id, "timestamp", severity_level, message FROM ({S.SQL_LOGS})
WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 1 HOUR AND service = 'webhook'
""")
def logs_recent(d: Data):
    rows = telemetry.logs_of_service(S.logs(d.events), "webhook", AS_OF)
    return rows.select("event_id", "timestamp", "severity_level", "message")


@query(f"""
SELECT event_id, "timestamp", severity_level, message FROM ({S.SQL_LOGS})
WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 24 HOUR AND service = 'poller' AND severity_level >= 3
""")
def logs_errors(d: Data):
    rows = telemetry.errors_of_service(S.logs(d.events), "poller", AS_OF)
    return rows.select("event_id", "timestamp", "severity_level", "message")


@query(f"""
SELECT 'job_' || event_type AS process, avg({S.SQL_MS}) AS avg_duration_ms, max({S.SQL_MS}) AS max_duration_ms,
       count(*) AS runs
FROM events WHERE event_type IN ('view', 'click') AND ts > {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY 1
""")
def duration_by_process(d: Data):
    return telemetry.duration_by_process(S.logs(d.events), "poller", AS_OF, "30 DAYS")


@query(f"""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'job_' || event_type END AS process,
       CASE WHEN event_type IN ('view', 'click') THEN CAST({S.SQL_K} AS BIGINT) END AS rows_read,
       CASE WHEN event_type IN ('view', 'click') THEN {S.SQL_MS} END AS duration_ms,
       CASE WHEN event_type = 'error' THEN CASE {S.SQL_K} % 3 WHEN 0 THEN '{S.REASONS[0]}'
            WHEN 1 THEN '{S.REASONS[1]}' ELSE '{S.REASONS[2]}' END END AS reason,
       CASE WHEN event_type = 'error' THEN 'payment' END AS rejected_type,
       CASE WHEN event_type IN ('view', 'click') THEN 'poller' ELSE 'unknown' END AS service
FROM events
""")
def message_parse(d: Data):
    sync, reject = parse_sync_message(F.col("message")), parse_reject_message(F.col("message"))
    service = F.when(F.col("service") == "poller", F.col("service"))
    return S.logs(d.events).select(
        "event_id", sync.alias("s"), reject.alias("r"), with_service(service, "unknown").alias("service")
    ).select("event_id", "s.process", "s.rows_read", "s.duration_ms", "r.reason",
             F.col("r.event_type").alias("rejected_type"), "service")


@query(f"""
SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS bin, round(quantile_cont(duration, 0.5), 6) AS p50,
       round(quantile_cont(duration, 0.95), 6) AS p95, round(quantile_cont(duration, 0.99), 6) AS p99,
       count(*) AS "count"
FROM ({S.SQL_REQUESTS}) WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY 1
""")
def latency_percentiles(d: Data):
    out = telemetry.latency_percentiles(S.requests(d.events), AS_OF, "30 DAYS")
    return out.withColumns({p: F.round(p, 6) for p in ("p50", "p95", "p99")})


@query(f"""
SELECT result_code, time_bucket(INTERVAL 1 HOUR, "timestamp") AS bin, count(*) AS requests
FROM ({S.SQL_REQUESTS}) WHERE "timestamp" > {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY 1, 2
""")
def status_codes(d: Data):
    return telemetry.status_codes(S.requests(d.events), AS_OF, "30 DAYS")


@query(f"""
SELECT CASE {S.SQL_K} % 3 WHEN 0 THEN '{S.REASONS[0]}' WHEN 1 THEN '{S.REASONS[1]}' ELSE '{S.REASONS[2]}' END AS reason,
       count(*) AS rejects
FROM events WHERE event_type = 'error' AND ts > {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY 1
""")
def rejects_by_reason(d: Data):
    return telemetry.rejects_by_reason(S.logs(d.events), "webhook", AS_OF, "30 DAYS")


@query(f"SELECT count(*) AS processed FROM events WHERE event_type = 'purchase' AND ts > {AS_OF_SQL} - INTERVAL 30 DAY")
def processed_count(d: Data):
    return telemetry.processed_count(S.logs(d.events), "webhook", AS_OF, "30 DAYS")


@query(f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin, avg({S.SQL_K}) AS average
FROM events WHERE ts > {AS_OF_SQL} - INTERVAL 30 DAY GROUP BY 1
""")
def backlog_avg(d: Data):
    gauges = d.events.select(F.col("ts").alias("timestamp"), S.k().alias("backlog"))
    return telemetry.gauge_average(gauges, F.col("backlog"), AS_OF, "30 DAYS")


# -- alerts ----------------------------------------------------------------------------
def _sliding_sql(where: str, agg: str, limit: int, window: int, every: int) -> str:
    return f"""
WITH e AS (SELECT ts, {S.SQL_K} AS k FROM events WHERE {where}),
     w AS (SELECT time_bucket(INTERVAL {every} MINUTE, ts) - to_minutes(CAST(i * {every} AS INTEGER)) AS window_start, k
           FROM e, range(0, {window // every}) AS r(i))
SELECT window_start, window_start + INTERVAL {window} MINUTE AS window_end, {agg} AS value
FROM w GROUP BY 1 HAVING {agg} > {limit}
"""


@query(_sliding_sql("event_type = 'error'", "count(*)", 1, 5, 1))
def alert_5xx(d: Data):
    rule = alerts.Threshold("5 minutes", "1 minute", "count", 1)
    return alerts.threshold_alert(d.events.where("event_type = 'error'"), "ts", rule)


@query(_sliding_sql("TRUE", "max(k)", 95, 15, 5))
def alert_backlog(d: Data):
    rule = alerts.Threshold("15 minutes", "5 minutes", "max", 95)
    return alerts.threshold_alert(d.events, "ts", rule, S.k())


@query(_sliding_sql("TRUE", "avg(k)", 80, 15, 5))
def alert_gauge(d: Data):
    return alerts.threshold_alert(d.events, "ts", alerts.CPU_LOAD, S.k())


@query("""
SELECT event_type, ts AS gap_start, next_ts AS gap_end,
       date_sub('second', ts, next_ts) AS gap_seconds
FROM (SELECT event_type, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS next_ts FROM events)
WHERE next_ts > ts + INTERVAL 30 MINUTE
""")
def alert_absence(d: Data):
    return alerts.absence_alert(d.events, "event_type", "ts")


@query("""
WITH a AS (SELECT max(ts) + INTERVAL 1 HOUR AS as_of FROM events),
     s AS (SELECT event_type, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS next_ts FROM events),
     g AS (SELECT event_type, ts, coalesce(next_ts, as_of) AS next_ts FROM s, a)
SELECT event_type, ts AS gap_start, next_ts AS gap_end, date_sub('second', ts, next_ts) AS gap_seconds
FROM g WHERE next_ts > ts + INTERVAL 30 MINUTE
UNION ALL SELECT 'nightly', NULL, as_of, NULL FROM a
""")
def alert_silent_now(d: Data):
    """Gaps up to an hour after the last event, with a process that is expected and never ran."""
    as_of = F.lit(d.events.agg(F.max("ts")).first()[0]) + F.expr("INTERVAL 1 HOUR")
    types = d.events.select("event_type").distinct()
    expected = types.unionByName(d.spark.createDataFrame([("nightly",)], "event_type STRING"))
    return alerts.absence_alert(
        d.events, "event_type", "ts", as_of=as_of.cast("timestamp_ntz"), expected=expected
    )


@query(_sliding_sql("event_type = 'purchase'", "sum(k)", 200, 15, 5))
def alert_sum(d: Data):
    """Threshold on a sum."""
    rule = alerts.Threshold("15 minutes", "5 minutes", "sum", 200)
    return alerts.threshold_alert(d.events.where("event_type = 'purchase'"), "ts", rule, S.k())


# -- signed notifications ------------------------------------------------------------------
SECRET = "local-check-secret"
RECEIVED_MS = "CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS BIGINT)"


def notifications(d: Data):
    """Events as notifications of every kind: fine, stale, early, malformed, foreign."""
    stamp = f"""CASE {_kind()} WHEN 0 THEN {RECEIVED_MS} - 301000 WHEN 1 THEN {RECEIVED_MS} + 301000
        ELSE {RECEIVED_MS} - 1000 END"""
    return d.events.selectExpr(
        "event_id",
        """CASE WHEN event_type = 'signup' THEN concat('{"topic":"payment","id":', event_id, '}')
             WHEN event_type = 'error' THEN concat('{"type":"payment",', event_id)
             WHEN event_type = 'click' THEN '{"type":"payment"}'
             WHEN event_type = 'purchase' THEN concat('{"type":"invoice","data":{"id":', event_id, '}}')
             ELSE concat('{"type":"payment","data":{"id":"', event_id, '"}}') END AS body""",
        f"""CASE {_kind()} WHEN 2 THEN NULL WHEN 3 THEN 'v1=abc' WHEN 4 THEN 'ts=soon,v1=abc'
             WHEN 5 THEN concat('v1 = abc , ts= ', {stamp}) ELSE concat('ts=', {stamp}, ',v1=abc') END AS x_signature""",
        f"CASE {_kind()} WHEN 6 THEN '' ELSE concat('req-', event_id) END AS x_request_id",
        "ts AS received_at",
    )


def _kind() -> str:
    return "(CAST(get_json_object(props, '$.k') AS INT) div 10)"


@query(f"""
WITH e AS (SELECT *, {S.SQL_K} // 10 AS g,
             CASE WHEN event_type = 'click' THEN '' ELSE CAST(event_id AS VARCHAR) END AS data_id,
             CASE WHEN event_type = 'purchase' THEN 'invoice' ELSE 'payment' END AS kind FROM events),
c AS (SELECT *, CASE WHEN g = 2 THEN 'missing_x_signature' WHEN g = 6 THEN 'missing_x_request_id'
        WHEN data_id = '' THEN 'missing_data_id' WHEN g = 3 THEN 'malformed_x_signature'
        WHEN g = 4 THEN 'ts_not_integer' WHEN g = 0 THEN 'ts_too_old(301s)'
        WHEN g = 1 THEN 'ts_in_future(-301s)' ELSE 'ok' END AS age FROM e)
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE data_id END AS data_id,
       CASE WHEN event_type = 'error' THEN '' ELSE kind END AS event_type,
       CASE WHEN event_type = 'error' THEN 400 WHEN age <> 'ok' THEN 401 WHEN kind <> 'payment' THEN 200 ELSE 202 END AS status_code,
       CASE WHEN event_type = 'error' THEN 'invalid_json' WHEN age <> 'ok' THEN age
            WHEN kind <> 'payment' THEN 'ignored' ELSE 'accepted' END AS reason
FROM c
""")
def signature_parse_and_age(d: Data):
    return triage.triage_unsigned(notifications(d)).select(
        "event_id", "data_id", "event_type", "status_code", "reason"
    )


@query(f"""
SELECT event_id, CAST(epoch_us(ts) // 1000 - CASE {S.SQL_K} // 10 WHEN 0 THEN 301000 WHEN 1 THEN -301000 ELSE 1000 END AS VARCHAR) AS sent,
       'abc' AS v1,
       'id:' || event_id || ';request-id:req-' || event_id || ';ts:'
         || (epoch_us(ts) // 1000 - CASE {S.SQL_K} // 10 WHEN 0 THEN 301000 WHEN 1 THEN -301000 ELSE 1000 END) || ';' AS manifest
FROM events WHERE {S.SQL_K} // 10 NOT IN (2, 3, 4, 6)
""")
def signature_manifest(d: Data):
    sig = signed.parse_signature(F.col("x_signature"))
    rows = notifications(d).withColumn("sig", sig).where(
        F.col("sig.ts").try_cast("bigint").isNotNull() & (F.col("x_request_id") != "")
    )
    return rows.select(
        "event_id", F.col("sig.ts").alias("sent"), F.col("sig.v1").alias("v1"),
        signed.manifest(F.col("event_id").cast("string"), F.col("x_request_id"), F.col("sig.ts"))
        .alias("manifest"),
    )


@query(f"""
WITH e AS (SELECT *, {S.SQL_K} // 10 AS g,
             CASE WHEN event_type = 'click' THEN '' ELSE CAST(event_id AS VARCHAR) END AS data_id,
             CASE WHEN event_type = 'purchase' THEN 'invoice' ELSE 'payment' END AS kind FROM events),
c AS (SELECT *, CASE WHEN g = 6 THEN 'missing_x_request_id' WHEN data_id = '' THEN 'missing_data_id'
        WHEN event_id % 2 = 1 THEN 'hmac_mismatch' ELSE 'ok' END AS age FROM e)
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE data_id END AS data_id,
       CASE WHEN event_type = 'error' THEN '' ELSE kind END AS event_type,
       CASE WHEN event_type = 'error' THEN 400 WHEN age <> 'ok' THEN 401 WHEN kind <> 'payment' THEN 200 ELSE 202 END AS status_code,
       CASE WHEN event_type = 'error' THEN 'invalid_json' WHEN age <> 'ok' THEN age
            WHEN kind <> 'payment' THEN 'ignored' ELSE 'accepted' END AS reason
FROM c
""")
def triage_events(d: Data):
    """All notifications signed: genuine ones pass, forged ones do not."""
    rows = notifications(d).drop("x_signature")
    ts = F.expr("CAST(unix_millis(CAST(received_at AS TIMESTAMP)) - 1000 AS STRING)")
    rows = triage.triage_unsigned(
        rows.withColumn("x_signature", F.concat(F.lit("ts="), ts, F.lit(",v1=x")))
    ).drop("status_code", "reason", "event_type").withColumn("sent", ts)
    text = signed.manifest(F.col("data_id"), F.col("x_request_id"), F.col("sent"))
    mark = F.when(F.col("event_id") % 2 == 0, signed.sign_with(SECRET)(text)).otherwise("forged")
    rows = rows.withColumn("x_signature", F.concat(F.lit("ts="), "sent", F.lit(",v1="), mark))
    return triage.triage_events(rows.drop("data_id", "sent"), SECRET).select(
        "event_id", "data_id", "event_type", "status_code", "reason"
    )
