"""Ledger-shaped inputs derived row by row from the given tables.

Nested documents are built from the columns of one row, so no grouping is needed to make
them and their number grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def lit_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out by their key before documents are made of them: a landed zone is many files,
    whatever number of files and row groups the table that stands for it has."""
    return df.repartition(F.col(df.columns[0]))


STATUS = "CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'refunded' ELSE 'pending' END"
PRIORITY = "CAST(substring(o_orderpriority, 1, 1) AS INT)"


def zoned(c: str) -> str:
    return f"concat(date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), '-04:00')"


def priority() -> Column:
    return F.expr(PRIORITY)


def payment_status() -> Column:
    return F.expr(STATUS)


def payment_doc(status: str = STATUS, updated: str = "o_orderdate") -> Column:
    """One order as a payment document (JSON text)."""
    amount = f"CAST(o_totalprice AS {MONEY})"
    # 1 .. priority - 1, empty for the highest priority
    count = f"filter(sequence(1, 4), i -> i < {PRIORITY})"
    charge = f"""named_struct(
        'id', concat('fee-', i), 'type', 'fee',
        'accounts', named_struct('from', 'payer', 'to', 'collector'),
        'amounts', named_struct('original', {amount} - i, 'refunded', CAST(i AS {MONEY})),
        'metadata', named_struct('user_id', i, 'source', 'api'),
        'date_created', {zoned('o_orderdate')})"""
    item = f"""named_struct('id', concat(' I', i, ' '), 'title', concat('item ', i), 'quantity', i,
        'unit_price', CAST({amount} * i AS {MONEY}))"""
    return F.expr(f"""to_json(named_struct(
        'id', o_orderkey,
        'collector_id', if(o_orderstatus = 'P', 0, o_custkey + 1),
        'collector', named_struct('id', o_custkey + 2),
        'payer_id', o_custkey,
        'payer', named_struct(
            'id', CAST(o_custkey + 1000000 AS STRING),
            'email', concat('c', o_custkey, '@example.com'),
            'first_name', concat('Name ', o_custkey),
            'identification', named_struct('type', 'ID', 'number', CAST(o_custkey AS STRING))),
        'external_reference', concat('REF-', o_orderkey),
        'order', named_struct('id', o_orderkey, 'type', 'shop'),
        'status', {status},
        'status_detail', o_orderpriority,
        'currency_id', 'ARS',
        'installments', {PRIORITY},
        'transaction_amount', {amount},
        'transaction_details', named_struct('net_received_amount', {amount} - {PRIORITY}),
        'captured', o_orderstatus = 'O',
        'store_id', concat('S', {PRIORITY}),
        'pos_id', 'P1',
        'point_of_interaction', named_struct('type', 'POINT',
            'business_info', named_struct('branch', concat('branch ', {PRIORITY}))),
        'card', if(o_orderstatus = 'O', named_struct(
            'first_six_digits', '450995',
            'last_four_digits', lpad(CAST(o_custkey AS STRING), greatest(4, length(CAST(o_custkey AS STRING))), '0'),
            'cardholder', named_struct('name', 'HOLDER')), NULL),
        'date_created', {zoned('o_orderdate')},
        'date_approved', if(o_orderstatus = 'O', {zoned('o_orderdate')}, NULL),
        'date_last_updated', {zoned(updated)},
        'metadata', named_struct('note', o_orderpriority),
        'additional_info', named_struct('items', transform({count}, i -> {item}),
            'payer', named_struct('phone', 'x')),
        'charges_details', transform({count}, i -> {charge}),
        'platform_id', 'kept'))""")


def documents(orders: DataFrame) -> DataFrame:
    """Orders as payment documents. The explode stands for a file boundary: without it,
    filters on parsed fields would have the documents built again."""
    return dealt(orders).select(F.explode(F.array(payment_doc())).alias("body"))


def two_deliveries(orders: DataFrame) -> DataFrame:
    """Every order delivered twice: pending a day earlier, then in its final state."""
    first = payment_doc("'pending'", "o_orderdate - INTERVAL 1 DAY")
    docs = F.array(F.struct(F.lit(1).alias("seq"), first.alias("body")),
                   F.struct(F.lit(2).alias("seq"), payment_doc().alias("body")))
    return dealt(orders).select(F.explode(docs).alias("d")).select("d.seq", "d.body")


def payments(orders: DataFrame) -> DataFrame:
    """Orders as rows of the payments table."""
    return orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("payer_id"),
        F.concat(F.lit("REF-"), F.col("o_orderkey")).alias("external_reference"),
        payment_status().alias("status"),
        money("o_totalprice").alias("transaction_amount"),
        F.concat(F.lit("S"), priority()).alias("store_id"),
        F.lit("P1").alias("pos_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date_created"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date_last_updated"),
    )


SQL_PAYMENTS = """
    SELECT o_orderkey AS payment_id, o_custkey AS payer_id,
           'REF-' || o_orderkey AS external_reference,
           CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'refunded' ELSE 'pending' END AS status,
           CAST(o_totalprice AS DECIMAL(18,2)) AS transaction_amount,
           'S' || substr(o_orderpriority, 1, 1) AS store_id, 'P1' AS pos_id,
           CAST(o_orderdate AS TIMESTAMP) AS date_created,
           CAST(o_orderdate AS TIMESTAMP) AS date_last_updated
    FROM orders
"""


def movements(lineitem: DataFrame) -> DataFrame:
    """Line items as rows of the movements table; open lines are same-day rows."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("source_account"),
        F.col("l_orderkey").cast("string").alias("voucher_number"),
        F.col("l_linenumber").cast("string").alias("correlative_number"),
        F.col("l_partkey").cast("string").alias("operation_code_ib"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("process_date"),
        money("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("debit_credit_type"),
        F.when(F.col("l_returnflag") == "N", None)
        .when(F.col("l_linestatus") == "O", "dia").otherwise("anteriores").alias("movement_source"),
    )


SQL_MOVEMENTS = """
    SELECT CAST(l_suppkey AS VARCHAR) AS source_account, CAST(l_orderkey AS VARCHAR) AS voucher_number,
           CAST(l_linenumber AS VARCHAR) AS correlative_number,
           CAST(l_partkey AS VARCHAR) AS operation_code_ib,
           CAST(l_shipdate AS TIMESTAMP) AS process_date,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag AS debit_credit_type,
           CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 'dia'
                ELSE 'anteriores' END AS movement_source
    FROM lineitem
"""


def k() -> Column:
    """The integer inside an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


def millis() -> Column:
    return F.round(F.col("value") * 1000).cast("bigint")


SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SQL_MS = "CAST(round(value * 1000) AS BIGINT)"


def runs(events: DataFrame) -> DataFrame:
    """Events as rows of the run ledger; sign-ups have not finished yet."""
    running = F.col("event_type") == "signup"
    error = F.col("event_type") == "error"
    ts = F.col("ts").cast("timestamp_ntz")
    return events.select(
        F.col("event_id").alias("sync_run_id"),
        F.when(F.col("event_type").isin("view", "click", "error"), "IB").otherwise("MP")
        .alias("source_system"),
        F.concat(F.lit("job_"), F.col("event_type")).alias("process_name"),
        ts.alias("started_at"),
        F.when(~running, F.timestamp_add("MILLISECOND", millis(), ts)).alias("finished_at"),
        F.when(running, "RUNNING").when(error, "ERROR").otherwise("SUCCESS").alias("status"),
        F.when(~running, k().cast("bigint")).alias("rows_read"),
        F.when(~running & ~error, k().cast("bigint")).alias("rows_upserted"),
        F.when(error, F.concat(F.lit("code "), k())).alias("error_message"),
    )


SQL_RUNS = f"""
    SELECT event_id AS sync_run_id,
           CASE WHEN event_type IN ('view', 'click', 'error') THEN 'IB' ELSE 'MP' END AS source_system,
           'job_' || event_type AS process_name, ts AS started_at,
           CASE WHEN event_type <> 'signup' THEN ts + to_milliseconds({SQL_MS}) END AS finished_at,
           CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status,
           CASE WHEN event_type <> 'signup' THEN CAST({SQL_K} AS BIGINT) END AS rows_read,
           CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST({SQL_K} AS BIGINT) END AS rows_upserted,
           CASE WHEN event_type = 'error' THEN 'code ' || {SQL_K} END AS error_message
    FROM events
"""


def control(events: DataFrame) -> DataFrame:
    """One control row per process; a process that only failed never succeeded."""
    good = F.col("status") == "SUCCESS"
    return (
        runs(events).groupBy("process_name")
        .agg(
            F.max("source_system").alias("source_system"),
            F.max(F.when(good, F.col("finished_at"))).alias("last_successful_sync"),
            F.max("started_at").alias("last_attempt_sync"),
            F.max_by("status", F.struct("started_at", "sync_run_id")).alias("last_status"),
            F.max_by("error_message", F.struct("started_at", "sync_run_id")).alias("last_error"),
        )
        .withColumns(
            {
                "last_begin_date_used": F.lit(None).cast("timestamp_ntz"),
                "last_end_date_used": F.lit(None).cast("timestamp_ntz"),
                "updated_at": F.col("last_attempt_sync"),
            }
        )
    )


SQL_CONTROL = f"""
    SELECT process_name, max(source_system) AS source_system,
           max(CASE WHEN status = 'SUCCESS' THEN finished_at END) AS last_successful_sync,
           max(started_at) AS last_attempt_sync,
           max(CASE WHEN rn = 1 THEN status END) AS last_status,
           max(CASE WHEN rn = 1 THEN error_message END) AS last_error,
           CAST(NULL AS TIMESTAMP) AS last_begin_date_used,
           CAST(NULL AS TIMESTAMP) AS last_end_date_used, max(started_at) AS updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY process_name ORDER BY started_at DESC, sync_run_id DESC) AS rn
          FROM ({SQL_RUNS}))
    GROUP BY process_name
"""

REASONS = ("hmac_mismatch", "ts_too_old(301s)", "missing_data_id")


def logs(events: DataFrame) -> DataFrame:
    """Events as structured log rows of the two services."""
    kind = F.col("event_type")
    count = k().cast("string")
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), (k() % len(REASONS)) + 1)
    message = (
        F.when(
            kind.isin("view", "click"),
            F.concat(F.lit("sync job_"), kind, F.lit(" OK: read="), count, F.lit(" upserted="),
                     count, F.lit(" duration_ms="), millis()),
        )
        .when(kind == "error", F.concat(F.lit("[x] HMAC inválido ("), reason,
                                        F.lit(") para event_type=payment")))
        .when(kind == "purchase", F.concat(F.lit("[x] payment "), F.col("event_id"),
                                           F.lit(" procesado: skipped=False charges=1 items=0")))
        .otherwise("heartbeat")
    )
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.when(kind.isin("view", "click"), "poller").otherwise("webhook").alias("service"),
        F.when((kind == "error") | ((kind == "view") & (k() > 50)), 3).otherwise(1)
        .alias("severity_level"),
        message.alias("message"),
    )


SQL_LOGS = f"""
    SELECT event_id, ts AS "timestamp",
           CASE WHEN event_type IN ('view', 'click') THEN 'poller' ELSE 'webhook' END AS service,
           CASE WHEN event_type = 'error' OR (event_type = 'view' AND {SQL_K} > 50) THEN 3 ELSE 1 END AS severity_level,
           CASE WHEN event_type IN ('view', 'click')
                THEN 'sync job_' || event_type || ' OK: read=' || {SQL_K} || ' upserted=' || {SQL_K}
                     || ' duration_ms=' || {SQL_MS}
                WHEN event_type = 'error'
                THEN '[x] HMAC inválido (' || CASE {SQL_K} % 3 WHEN 0 THEN '{REASONS[0]}'
                     WHEN 1 THEN '{REASONS[1]}' ELSE '{REASONS[2]}' END || ') para event_type=payment'
                WHEN event_type = 'purchase'
                THEN '[x] payment ' || event_id || ' procesado: skipped=False charges=1 items=0'
                ELSE 'heartbeat' END AS message
    FROM events
"""


def requests(events: DataFrame) -> DataFrame:
    """Events as served requests."""
    kind = F.col("event_type")
    return events.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("value").alias("duration"),
        F.when(kind == "error", "500").when(kind == "signup", "401").otherwise("202")
        .alias("result_code"),
    )


SQL_REQUESTS = """
    SELECT ts AS "timestamp", value AS duration,
           CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '401' ELSE '202' END AS result_code
    FROM events
"""
