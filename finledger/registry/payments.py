"""Queries on payment documents and payment tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.functions.redact import redact_payment as redact
from finledger.operators import filters, mutate
from finledger.operators.dedup import keep_first as first_per
from finledger.operators.dedup import keep_last as last_per
from finledger.operators.flatten import payment_charges, payment_items, payment_parent
from finledger.plans import payments as plan
from finledger.plans import reports
from finledger.registry import standins as S
from finledger.registry.core import Data, query
from finledger.schemas import SPECS
from finledger.sources.conform import conform
from finledger.sources.landing import inspect_sections

AS_OF = "2001-08-02 00:00:00"
CUT = "2000-01-01"


def docs(d: Data):
    return S.documents(d.orders)


@query("""
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS payments
FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-02' - INTERVAL 30 DAY
GROUP BY 1
""")
def payments_per_day(d: Data):
    """Deliveries deduplicated, parsed, merged into the stored table, counted per day."""
    stored = S.payments(d.orders.where(F.col("o_orderdate") < CUT))
    stored = conform(stored, SPECS["mp_payments"].schema)
    merged = plan.merged_payments(S.two_deliveries(d.orders), stored, ["seq"], S.lit_ts(AS_OF))
    return reports.payments_per_day(merged, AS_OF)


@query("""
SELECT o_orderkey AS payment_id,
       CASE WHEN o_orderstatus = 'P' THEN o_custkey + 2 ELSE o_custkey + 1 END AS collector_id,
       CASE WHEN o_custkey = 0 THEN 1000000 ELSE o_custkey END AS payer_id,
       'REF-' || o_orderkey AS external_reference, CAST(o_orderkey AS VARCHAR) AS order_id,
       'shop' AS order_type,
       CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'refunded' ELSE 'pending' END AS status,
       o_orderpriority AS status_detail, 'ARS' AS currency_id,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS installments,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS transaction_amount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE) AS net_received_amount,
       o_orderstatus = 'O' AS captured, 'S' || substr(o_orderpriority, 1, 1) AS store_id,
       'branch ' || substr(o_orderpriority, 1, 1) AS point_branch,
       'c' || o_custkey || '@example.com' AS payer_email,
       CAST(o_custkey AS VARCHAR) AS payer_identification_number,
       CASE WHEN o_orderstatus = 'O' THEN right('0000' || o_custkey, greatest(4, length(CAST(o_custkey AS VARCHAR)))) END AS card_last_four_digits,
       CASE WHEN o_orderstatus = 'O' THEN 'HOLDER' END AS cardholder_name,
       CAST(o_orderdate AS TIMESTAMP) AS date_created,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS TIMESTAMP) END AS date_approved
FROM orders
""")
def payment_parent_roundtrip(d: Data):
    columns = """payment_id collector_id payer_id external_reference order_id order_type status
        status_detail currency_id installments transaction_amount net_received_amount captured
        store_id point_branch payer_email payer_identification_number card_last_four_digits
        cardholder_name date_created date_approved"""
    return payment_parent(docs(d)).select(*columns.split())


CHARGES_SQL = """
SELECT o_orderkey AS payment_id, 'fee-' || i AS charge_id, 'fee' AS charge_type,
       'payer' AS account_from, 'collector' AS account_to,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) - i AS DOUBLE) AS amount_original,
       CAST(i AS DOUBLE) AS amount_refunded, CAST(i AS BIGINT) AS metadata_user_id,
       CAST(o_orderdate AS TIMESTAMP) AS charge_date_created
FROM orders, range(1, 6) AS r(i)
WHERE i < CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
"""


@query(CHARGES_SQL)
def charges_explode(d: Data):
    return payment_charges(docs(d)).select(
        "payment_id", "charge_id", "charge_type", "account_from", "account_to", "amount_original",
        "amount_refunded", "metadata_user_id", "charge_date_created",
    )


@query("""
SELECT o_orderkey AS payment_id, 'I' || i AS item_id, 'item ' || i AS title,
       CAST(i AS DOUBLE) AS quantity,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * i AS DOUBLE) AS unit_price
FROM orders, range(1, 6) AS r(i)
WHERE i < CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
""")
def items_explode(d: Data):
    return payment_items(docs(d)).select(
        "payment_id", "item_id", "title", "quantity", "unit_price"
    )


@query(f"""
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount, date_created
FROM ({S.SQL_PAYMENTS})
WHERE status = 'approved' AND date_created BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-12-31'
""")
def payments_search(d: Data):
    """Search pages whose windows overlap: each payment comes back twice."""
    pages = S.dealt(d.orders).select(
        F.lit(1).alias("page"),
        F.concat(F.lit('{"paging":{"total":2},"results":['), S.payment_doc(), F.lit(","),
                 S.payment_doc(), F.lit("]}")).alias("body"),
    )
    rows = payment_parent(plan.search_results(pages), keep=("page", "pos"))
    once = first_per(
        rows.select("payment_id", "status", "transaction_amount", "date_created", "page", "pos"),
        ["payment_id"], ["page", "pos"],
    ).drop("page", "pos")
    return filters.search_payments(once, S.lit_ts("1998-01-01"), S.lit_ts("2000-12-31"),
                                   "date_created", "approved")


@query("""
SELECT count(*) AS total, count(*) AS transaction_details,
       count(*) AS point_of_interaction,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS card,
       count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) <> '1') AS charges_details,
       count(*) FILTER (WHERE substr(o_orderpriority, 1, 1) <> '1') AS items
FROM orders
""")
def section_presence(d: Data):
    sections = {
        "transaction_details": "$.transaction_details",
        "point_of_interaction": "$.point_of_interaction",
        "card": "$.card",
        "charges_details": "$.charges_details",
        "items": "$.additional_info.items",
    }
    return inspect_sections(docs(d), "body", sections)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, '***REDACTED***' AS email,
       CAST(o_custkey + 1000000 AS VARCHAR) AS payer_id, '***REDACTED***' AS number,
       'ID' AS id_type,
       CASE WHEN o_orderstatus = 'O' THEN '***REDACTED***' END AS card_last,
       CASE WHEN o_orderstatus = 'O' THEN '***REDACTED***' END AS holder,
       '***REDACTED***' AS metadata, '***REDACTED***' AS info_payer, 'kept' AS platform_id,
       CASE WHEN substr(o_orderpriority, 1, 1) <> '1' THEN 'item 1' END AS first_item
FROM orders
""")
def redact_payment(d: Data):
    members = {
        "id": "id", "email": "payer.email", "payer_id": "payer.id",
        "number": "payer.identification.number", "id_type": "payer.identification.type",
        "card_last": "card.last_four_digits", "holder": "card.cardholder.name",
        "metadata": "metadata", "info_payer": "additional_info.payer",
        "platform_id": "platform_id", "first_item": "get(additional_info.items, 0).title",
    }
    shape = """id STRING, payer STRUCT<email STRING, id STRING, identification STRUCT<number STRING, type STRING>>,
        card STRUCT<last_four_digits STRING, cardholder STRUCT<name STRING>>, metadata STRING,
        additional_info STRUCT<payer STRING, items ARRAY<STRUCT<title STRING>>>, platform_id STRING"""
    # inline, so that the redacted text is read once and not once per member
    raw = docs(d).selectExpr(f"inline(array(from_json({redact('body')}, '{' '.join(shape.split())}')))")
    return raw.selectExpr(*[f"{path} AS {name}" for name, path in members.items()])


# -- mutation -----------------------------------------------------------------
UPSERT_COLS = ["status", "transaction_amount"]


def stored_payments(d: Data):
    return S.payments(d.orders.where(F.col("o_orderdate") < CUT)).select(
        "payment_id", "status", "transaction_amount",
        S.lit_ts("1999-12-31").alias("created_at"), S.lit_ts("1999-12-31").alias("updated_at"),
    )


def batch_payments(d: Data):
    """The next batch reads half a year back, as an incremental window does."""
    rows = S.payments(d.orders.where(F.col("o_orderdate") >= "1999-07-01"))
    return rows.select(
        "payment_id", F.when(F.col("status") != "pending", F.lit("settled")).alias("status"),
        (F.col("transaction_amount") + 10).cast(S.MONEY).alias("transaction_amount"),
    )


@query(f"""
WITH t AS (SELECT * FROM ({S.SQL_PAYMENTS}) WHERE date_created < TIMESTAMP '2000-01-01'),
     s AS (SELECT payment_id, CASE WHEN status <> 'pending' THEN 'settled' END AS status,
                  transaction_amount + 10 AS transaction_amount
           FROM ({S.SQL_PAYMENTS}) WHERE date_created >= TIMESTAMP '1999-07-01')
SELECT coalesce(t.payment_id, s.payment_id) AS payment_id,
       CASE WHEN s.payment_id IS NULL THEN t.status ELSE s.status END AS status,
       CAST(CASE WHEN s.payment_id IS NULL THEN t.transaction_amount ELSE s.transaction_amount END AS DOUBLE) AS transaction_amount,
       CASE WHEN t.payment_id IS NULL THEN TIMESTAMP '2001-08-02' ELSE TIMESTAMP '1999-12-31' END AS created_at,
       CASE WHEN s.payment_id IS NULL THEN TIMESTAMP '1999-12-31' ELSE TIMESTAMP '2001-08-02' END AS updated_at
FROM t FULL OUTER JOIN s ON t.payment_id = s.payment_id
""")
def merge_upsert(d: Data):
    return mutate.merge_upsert(
        stored_payments(d), batch_payments(d), ["payment_id"], UPSERT_COLS, S.lit_ts(AS_OF),
        "updated_at", ("created_at", "updated_at"),
    )


@query("""
SELECT o_orderkey AS payment_id, CAST(o_orderdate AS TIMESTAMP) AS date_last_updated FROM orders
WHERE NOT (o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '2000-01-01')
""")
def skip_unchanged(d: Data):
    """Stored: same version for open orders, a newer one for closed, none for pending."""
    old = d.orders.where(F.col("o_orderdate") < CUT)
    version = F.col("o_orderdate").cast("timestamp_ntz")
    stored = old.select(
        F.col("o_orderkey").alias("payment_id"),
        F.when(F.col("o_orderstatus") == "O", version)
        .when(F.col("o_orderstatus") == "F", version + F.expr("INTERVAL 1 DAY"))
        .alias("date_last_updated"),
    )
    batch = S.payments(d.orders).select("payment_id", "date_last_updated")
    return mutate.skip_unchanged(batch, stored, "payment_id", "date_last_updated")


@query(f"""
SELECT l_orderkey AS payment_id, 'line-' || l_linenumber AS charge_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount_original
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL
SELECT payment_id, charge_id, amount_original
FROM ({CHARGES_SQL}) WHERE charge_date_created >= TIMESTAMP '2000-01-01'
""")
def replace_children(d: Data):
    old = d.lineitem.select(
        F.col("l_orderkey").alias("payment_id"),
        F.concat(F.lit("line-"), F.col("l_linenumber")).alias("charge_id"),
        S.money("l_extendedprice").alias("amount_original"),
    )
    touched = d.orders.where(F.col("o_orderdate") >= CUT)
    new = payment_charges(S.documents(touched))
    parents = touched.select(F.col("o_orderkey").alias("payment_id"))
    return mutate.replace_children(old, parents, new, "payment_id")


@query(f"""
WITH ins AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT (SELECT max(o_orderkey + 1) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
       + row_number() OVER (ORDER BY o_orderkey) AS row_id, o_orderkey AS payment_id
FROM ins
""")
def surrogate_ids(d: Data):
    stored = d.orders.where(F.col("o_orderdate") < CUT).select((F.col("o_orderkey") + 1).alias("row_id"))
    inserts = d.orders.where(F.col("o_orderdate") >= CUT).select(F.col("o_orderkey").alias("payment_id"))
    block = F.floor(F.col("payment_id") / 10000)
    return mutate.assign_surrogate(stored, inserts, "row_id", "payment_id", block)


@query(f"""
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount, 'stored' AS origin
FROM ({S.SQL_PAYMENTS}) WHERE date_created < TIMESTAMP '2000-01-01'
UNION ALL
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE), 'seed'
FROM ({S.SQL_PAYMENTS}) WHERE date_created >= TIMESTAMP '2000-01-01'
""")
def insert_missing(d: Data):
    rows = S.payments(d.orders)
    stored = rows.where(F.col("date_created") < CUT).withColumn("origin", F.lit("stored"))
    keep = ["payment_id", "status", "transaction_amount", "origin"]
    return mutate.insert_missing(
        stored.select(*keep), rows.withColumn("origin", F.lit("seed")).select(*keep), ["payment_id"]
    )


@query(f"""
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       CAST(NULL AS VARCHAR) AS processing_mode, CAST(NULL AS TIMESTAMP) AS money_release_date
FROM ({S.SQL_PAYMENTS})
""")
def evolve_schema(d: Data):
    old = S.payments(d.orders).select("payment_id", "status", "transaction_amount")
    schema = T.StructType(
        [*old.schema, T.StructField("processing_mode", T.StringType()),
         T.StructField("money_release_date", T.TimestampNTZType())]
    )
    return mutate.evolve(old, schema)


@query("""
SELECT event_id, user_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def keep_last(d: Data):
    return last_per(d.events.select("event_id", "user_id", "event_type", "value", "ts"),
                    ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""
SELECT event_id, user_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
""")
def keep_first(d: Data):
    return first_per(d.events.select("event_id", "user_id", "event_type", "value", "ts"),
                     ["user_id"], ["ts", "event_id"]).drop("ts")


@query(f"""
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount FROM ({S.SQL_PAYMENTS})
""")
def overlapping_windows(d: Data):
    """Two overlapping reads of the payments put together, each payment once."""
    rows = S.payments(d.orders)
    keep = ["payment_id", "status", "transaction_amount"]
    early = rows.where(F.col("date_created") <= "2000-06-30").select(*keep, F.lit(1).alias("read"))
    late = rows.where(F.col("date_created") >= CUT).select(*keep, F.lit(2).alias("read"))
    return first_per(early.unionByName(late), ["payment_id"], ["read"]).drop("read")


# -- reports ------------------------------------------------------------------
@query(f"""
SELECT payment_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount, date_last_updated
FROM ({S.SQL_PAYMENTS}) ORDER BY date_last_updated DESC, payment_id DESC LIMIT 10
""")
def latest_payments(d: Data):
    rows = S.payments(d.orders).select("payment_id", "status", "transaction_amount", "date_last_updated")
    return reports.latest_payments(rows)


@query(f"""
SELECT payment_id, status, date_created, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       payer_id, external_reference
FROM ({S.SQL_PAYMENTS})
WHERE status = 'approved' AND date_created BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'
""")
def payments_by_status(d: Data):
    return reports.payments_by_status(S.payments(d.orders), "approved", "1999-01-01", "1999-12-31")


@query(f"""
SELECT payment_id, payer_id, status, CAST(transaction_amount AS DOUBLE) AS transaction_amount, date_created
FROM ({S.SQL_PAYMENTS}) WHERE payer_id = 7
""")
def payments_by_payer(d: Data):
    return reports.payments_by_payer(S.payments(d.orders), 7)


@query(f"""
SELECT payment_id, external_reference, status FROM ({S.SQL_PAYMENTS}) WHERE external_reference = 'REF-42'
""")
def payments_by_reference(d: Data):
    return reports.payments_by_reference(S.payments(d.orders), "REF-42").select(
        "payment_id", "external_reference", "status"
    )


@query(f"""
SELECT payment_id, store_id, pos_id, status FROM ({S.SQL_PAYMENTS}) WHERE store_id = 'S3' AND pos_id = 'P1'
""")
def payments_by_store(d: Data):
    return reports.payments_by_store(S.payments(d.orders), "S3", "P1").select(
        "payment_id", "store_id", "pos_id", "status"
    )
