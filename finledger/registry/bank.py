"""Queries on landed bank pages and bank tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.functions import scalars as X
from finledger.functions.redact import redact_bank as mask
from finledger.operators import audit, filters, flatten, keys, mutate
from finledger.operators.normalize import normalize
from finledger.plans import bank, reports
from finledger.registry import standins as S
from finledger.registry.core import Data, query
from finledger.sources import aliases as A
from finledger.sources import landing
from finledger.sources.conform import conform

AS_OF = "2002-01-01 00:00:00"
FETCHED = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def pages(df: DataFrame, body: str, account: str, kind: str = "NULL") -> DataFrame:
    """One landed page per row, with the given body."""
    return S.dealt(df).selectExpr(
        f"CAST({account} AS STRING) AS account_number", "'7' AS bank_number",
        f"CAST({kind} AS STRING) AS movement_type", "0 AS page", "100 AS page_size",
        f"{FETCHED} AS fetched_at", f"{body} AS body",
    )


# -- landed pages ---------------------------------------------------------------
@query("""
SELECT event_id, CAST(i AS INTEGER) AS pos, CAST(round(value * 100) AS BIGINT) + i AS cents
FROM events, range(0, 2) AS r(i) WHERE event_type <> 'error'
""")
def extract_records(d: Data):
    """Records under different envelope keys, as a bare array, and in unreadable bodies."""
    cents = "CAST(round(value * 100) AS BIGINT)"
    rows = f"concat('[{{\"c\":', {cents}, '}},{{\"c\":', {cents} + 1, '}}]')"
    body = f"""CASE event_type
        WHEN 'view' THEN concat('{{"general_data":{{"x":1}},"accounts":', {rows}, '}}')
        WHEN 'click' THEN {rows}
        WHEN 'purchase' THEN concat('{{"data":5,"movimientos":', {rows}, '}}')
        WHEN 'signup' THEN concat('{{"other":[],"results":', {rows}, '}}')
        ELSE concat('{{"oops":', {rows}) END"""
    df = S.dealt(d.events).selectExpr("event_id", f"{body} AS body", "0 AS page", f"{FETCHED} AS fetched_at")
    out = landing.extract_records(df)
    return out.select(
        "event_id", F.col("ordinal.pos").alias("pos"),
        F.try_variant_get("record", "$.c", "bigint").alias("cents"),
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS request_id, CAST(event_id AS INTEGER) AS page, event_type || '!' AS kind
FROM events
""")
def stitch_pages(d: Data):
    """Every page landed twice; the later landing counts."""
    both = S.dealt(d.events).selectExpr(
        "CAST(user_id AS STRING) AS request_id", "CAST(event_id AS INT) AS page",
        """explode(array(
            named_struct('fetched_at', ts, 'body', concat('{"data":[{"kind":"', event_type, '"}]}')),
            named_struct('fetched_at', ts + INTERVAL 1 HOUR,
                         'body', concat('{"data":[{"kind":"', event_type, '!"}]}')))) AS l""",
    ).select("request_id", "page", "l.*")
    record = A.T.StructType([A.T.StructField("kind", A.T.StringType())])
    out = landing.extract_records(landing.stitch_pages(both), record=record)
    return out.select("request_id", "page", "record.kind")


@query("""
WITH p AS (
    SELECT c_custkey, c_mktsegment, c_nationkey // 5 + 1 AS n, CAST(i AS INTEGER) AS page,
           CASE WHEN i < c_nationkey // 5 THEN 10 ELSE 3 END AS rec
    FROM customer, range(0, 5) AS r(i)
    WHERE i <= c_nationkey // 5
      AND NOT (c_mktsegment = 'MACHINERY' AND i = 1)
      AND NOT (c_mktsegment = 'FURNITURE' AND i = c_nationkey // 5 AND i > 0)),
a AS (SELECT c_custkey, max(n) AS n, max(page) AS last_page, count(*) AS landed, sum(rec) AS records
      FROM p GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS request_id, landed AS pages_landed, last_page,
       CAST(records AS BIGINT) AS records, last_page + 1 < n AS more_expected,
       CAST(last_page + 1 - landed AS BIGINT) AS missing_pages,
       last_page + 1 = landed AND NOT (last_page + 1 < n) AS complete
FROM a
""")
def page_completeness(d: Data):
    """Requests of 1 to 5 pages. One segment lost a middle page, another its last one, and
    each segment announces its size in another way."""
    n, last = "(c_nationkey div 5 + 1)", "(c_nationkey div 5)"
    size = f"if(i < {last}, 10, 3)"
    rows = f"concat('[', array_join(transform(sequence(1, {size}), x -> '{{\"a\":1}}'), ','), ']')"
    total = f"{last} * 10 + 3"
    body = f"""CASE c_mktsegment
        WHEN 'BUILDING' THEN concat('{{"general_data":{{"total_rows":"', {total}, '"}},"data":', {rows}, '}}')
        WHEN 'AUTOMOBILE' THEN concat('{{"totalPages":', {n}, ',"data":', {rows}, '}}')
        WHEN 'MACHINERY' THEN concat('{{"last":', i = {last}, ',"data":', {rows}, '}}')
        WHEN 'FURNITURE' THEN concat('{{"totalElements":', {total}, ',"data":', {rows}, '}}')
        ELSE {rows} END"""
    df = S.dealt(d.customer).selectExpr("*", f"explode(sequence(0, CAST({last} AS INT))) AS i").where(
        f"NOT (c_mktsegment = 'MACHINERY' AND i = 1) "
        f"AND NOT (c_mktsegment = 'FURNITURE' AND i = {last} AND i > 0)"
    )
    landed = df.selectExpr(
        "CAST(c_custkey AS STRING) AS request_id", "i AS page", "10 AS page_size",
        f"{FETCHED} AS fetched_at", f"{body} AS body",
    )
    return landing.page_completeness(landed)


# -- conforming and flattening ----------------------------------------------------
@query("""
SELECT 'CBU' || s_suppkey AS account_cbu, CAST(s_nationkey AS VARCHAR) AS bank_number,
       CAST(NULL AS VARCHAR) AS account_cuit, s_name AS account_label, 'ARS' AS currency,
       'bank ' || s_nationkey AS bank_name, CAST(s_suppkey AS VARCHAR) AS account_number, 'CC' AS account_type
FROM supplier
""")
def alias_fold(d: Data):
    """Accounts in three spellings, by bank."""
    body = """CASE WHEN s_nationkey < 8 THEN to_json(named_struct('accounts', array(named_struct(
            'account_cbu', concat('CBU', s_suppkey), 'bank_number', s_nationkey,
            'account_label', s_name, 'currency', 'ARS', 'bank_name', concat('bank ', s_nationkey),
            'account_number', s_suppkey, 'account_type', 'CC', 'unknown', 1))))
        WHEN s_nationkey < 16 THEN to_json(array(named_struct(
            'cbu', concat('CBU', s_suppkey), 'bankNumber', s_nationkey, 'label', s_name,
            'currency', 'ARS', 'bankName', concat('bank ', s_nationkey),
            'accountNumber', s_suppkey, 'accountType', 'CC')))
        ELSE to_json(named_struct('cuentas', array(named_struct(
            'cbu', concat('CBU', s_suppkey), 'numeroBanco', s_nationkey, 'descripcion', s_name,
            'moneda', 'ARS', 'nombreBanco', concat('bank ', s_nationkey),
            'numeroCuenta', s_suppkey, 'tipoCuenta', 'CC')))) END"""
    rows = bank.wire_rows(pages(d.supplier, body, "NULL"), "account")
    return conform(rows, list(A.ACCOUNT))


BALANCE_BODY = """to_json(named_struct('data', array(named_struct(
    'bank_number', c_nationkey, 'account_number', c_custkey, 'account_type', 'CC',
    'currency', 'ARS', 'account_label', c_name, 'row_date', '2024-01-31',
    'balances', named_struct('countable_balance', CAST(c_acctbal AS DECIMAL(18,2)),
                             'current_operating_balance', CAST(c_acctbal AS DECIMAL(18,2)) + 1),
    'historical_balances', transform(filter(sequence(1, 4), i -> i <= c_nationkey div 5),
        i -> named_struct('operation_date', concat('2024-01-0', i),
                          'day_balance', CAST(c_acctbal AS DECIMAL(18,2)) - i,
                          'total_debits', i, 'total_credits', i * 2))))))"""


def balance_rows(d: Data) -> DataFrame:
    return bank.wire_rows(pages(d.customer, BALANCE_BODY, "NULL"), "balance")


SQL_BALANCES = """
    SELECT CAST(c_custkey AS VARCHAR) AS account_number, c_name AS account_label, c_nationkey AS bank_number,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS countable_balance,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 1 AS DOUBLE) AS current_operating_balance,
           CASE WHEN i > 0 THEN TIMESTAMP '2023-12-31' + to_days(CAST(i AS INTEGER)) END AS operation_date,
           CASE WHEN i > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) - i AS DOUBLE) END AS day_balance,
           CASE WHEN i > 0 THEN CAST(i AS DOUBLE) END AS total_debits,
           CASE WHEN i > 0 THEN CAST(2 * i AS DOUBLE) END AS total_credits,
           CASE WHEN i > 0 THEN TRUE END AS is_historical
    FROM customer, range(0, 5) AS r(i) WHERE i <= c_nationkey // 5
"""


@query(f"SELECT * FROM ({SQL_BALANCES})")
def balances_flatten(d: Data):
    rows = normalize(balance_rows(d), "balance")
    return rows.select(
        "account_number", "account_label", "bank_number", "countable_balance",
        "current_operating_balance", "operation_date", "day_balance", "total_debits",
        "total_credits", "is_historical",
    )


@query(f"""
SELECT account_number, account_label, bank_number, countable_balance,
       CAST(NULL AS DOUBLE) AS initial_operating_balance, current_operating_balance,
       CAST(NULL AS DOUBLE) AS projected_balance_24hs, CAST(NULL AS DOUBLE) AS projected_balance_48hs
FROM ({SQL_BALANCES}) WHERE NOT coalesce(is_historical, FALSE)
""")
def current_balances(d: Data):
    return reports.current_balances(normalize(balance_rows(d), "balance"))


@query(f"""
SELECT account_number, operation_date, day_balance, total_debits, total_credits
FROM ({SQL_BALANCES}) WHERE coalesce(is_historical, FALSE)
""")
def historical_balances(d: Data):
    return reports.historical_balances(normalize(balance_rows(d), "balance"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS account_number, TIMESTAMP '2024-01-31' AS row_date,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS countable_balance
FROM customer WHERE c_custkey = 7
""")
def balances_by_account(d: Data):
    rows = normalize(balance_rows(d), "balance").where(filters.current_only())
    return reports.balances_by_account(rows, "7", "2024-01-01", "2024-01-31").select(
        "account_number", "row_date", "countable_balance"
    )


STATEMENT_BODY = f"""CASE WHEN o_orderstatus = 'F' THEN
    to_json(named_struct('statements', array(named_struct('statement_number', o_orderkey,
        'operation_date', date_format(o_orderdate, 'yyyy-MM-dd'),
        'total_movements', {S.PRIORITY} - 1, 'opening_balance', CAST(o_totalprice AS DECIMAL(18,2)),
        'ending_balance', CAST(o_totalprice AS DECIMAL(18,2)) + 5, 'movements_detail',
        transform(filter(sequence(1, 4), i -> i < {S.PRIORITY}), i -> named_struct(
            'importe', i * 10, 'voucherNumber', i, 'correlativo', i, 'tipoMovimiento', 'D'))))))
    ELSE to_json(named_struct('statements', array(named_struct('statement_number', o_orderkey,
        'operation_date', date_format(o_orderdate, 'yyyy-MM-dd'),
        'total_movements', {S.PRIORITY} - 1, 'opening_balance', CAST(o_totalprice AS DECIMAL(18,2)),
        'ending_balance', CAST(o_totalprice AS DECIMAL(18,2)) + 5, 'movement_detail',
        transform(filter(sequence(1, 4), i -> i < {S.PRIORITY}), i -> named_struct(
            'amount', i * 10, 'voucher_number', i, 'correlative_number', i,
            'debit_credit_type', 'D', 'operation_date', '2001-02-03')))))) END"""


def statement_pages(d: Data) -> DataFrame:
    return pages(d.orders, STATEMENT_BODY, "o_custkey")


SQL_STATEMENTS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS statement_number,
           CASE WHEN i > 0 AND o_orderstatus <> 'F' THEN TIMESTAMP '2001-02-03' ELSE CAST(o_orderdate AS TIMESTAMP) END AS operation_date,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS total_movements,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS opening_balance,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 5 AS DOUBLE) AS ending_balance,
           CASE WHEN i > 0 THEN CAST(i * 10 AS DOUBLE) END AS amount,
           CASE WHEN i > 0 THEN CAST(i AS VARCHAR) END AS voucher_number,
           CASE WHEN i > 0 THEN 'D' END AS debit_credit_type,
           CAST(o_custkey AS VARCHAR) AS source_account
    FROM orders, range(0, 5) AS r(i)
    WHERE i < CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
      AND (i > 0 OR substr(o_orderpriority, 1, 1) = '1')
"""


@query(f"SELECT * FROM ({SQL_STATEMENTS})")
def statements_flatten(d: Data):
    rows = normalize(bank.wire_rows(statement_pages(d), "extract"), "extract")
    return rows.select(
        "statement_number", "operation_date", "total_movements", "opening_balance",
        "ending_balance", "amount", "voucher_number", "debit_credit_type", "source_account",
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS statement_number,
       CASE WHEN o_orderstatus <> 'F' AND substr(o_orderpriority, 1, 1) <> '1'
            THEN '2001-02-03' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS operation_date,
       CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS VARCHAR) AS total_movements,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS opening_balance,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 5 AS DOUBLE) AS ending_balance
FROM orders
""")
def statement_summary(d: Data):
    rows = bank.wire_rows(statement_pages(d), "extract").withColumns(
        {"page": F.col("ordinal.page"), "seq": F.coalesce(X.read_id(F.col("correlative_number")), F.lit(0))}
    )
    out = reports.statement_summary(rows, ["page", "seq"])
    return out.withColumns(
        {c: F.col(c).cast(S.MONEY) for c in ("opening_balance", "ending_balance")}
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS statement_number, CAST(NULL AS TIMESTAMP) AS real_date_activity,
       CAST(i * 10 AS DOUBLE) AS amount, 'D' AS debit_credit_type,
       CAST(NULL AS VARCHAR) AS code_description_bank
FROM orders, range(1, 5) AS r(i)
WHERE o_orderkey = 0 AND i < CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
""")
def statement_detail(d: Data):
    rows = normalize(bank.wire_rows(statement_pages(d), "extract"), "extract", keep=("ordinal",))
    return reports.statement_detail(rows, "0", ["ordinal", "correlative_number"])


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS statement_number, CAST(o_custkey AS VARCHAR) AS source_account,
       CAST(o_orderdate AS TIMESTAMP) AS operation_date
FROM orders WHERE o_custkey = 7 AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '2000-12-31'
""")
def extracts_by_account(d: Data):
    extracts = d.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS statement_number", "CAST(o_custkey AS STRING) AS source_account",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS operation_date",
    )
    return reports.extracts_by_account(extracts, "7", "1997-01-01", "2000-12-31")


TRANSFER_BODY = f"""concat('{{"transfers":[', CASE o_orderstatus
    WHEN 'O' THEN to_json(named_struct('transfer_id', o_orderkey, 'amount', CAST(o_totalprice AS DECIMAL(18,2)),
        'request_date', {S.zoned('o_orderdate')}, 'status', 'done',
        'credit_account', named_struct('account_cbu', concat('C', o_custkey), 'bank_number', '007'),
        'debit_account', named_struct('customer_cuit', '20', 'account_number', 55),
        'addenda', named_struct('amount', {S.PRIORITY}, 'operation_numer', o_orderkey,
                                'due_date', '2001-01-31', 'beyond', 'x')))
    WHEN 'F' THEN to_json(named_struct('transferId', o_orderkey, 'amount', CAST(o_totalprice AS DECIMAL(18,2)),
        'requestDate', {S.zoned('o_orderdate')}, 'status', 'done',
        'creditAccount', named_struct('accountCbu', concat('C', o_custkey), 'bankNumber', 7),
        'debitAccount', named_struct('customerCuit', '20', 'accountNumber', '55'),
        'addenda', 'free text'))
    ELSE to_json(named_struct('id', o_orderkey, 'importe', CAST(o_totalprice AS DECIMAL(18,2)),
        'fechaSolicitud', {S.zoned('o_orderdate')}, 'estado', 'done',
        'cuentaCreditora', named_struct('cbu', concat('C', o_custkey), 'numeroBanco', 7),
        'cuentaDebitora', named_struct('cuit', '20', 'numeroCuenta', 55.0D))) END, ']}}')"""


def transfer_rows(d: Data) -> DataFrame:
    return normalize(
        bank.wire_rows(pages(d.orders, TRANSFER_BODY, "NULL"), "transfer"), "transfer"
    )


@query("""
SELECT o_orderkey AS transfer_id, CAST(o_orderdate AS TIMESTAMP) AS request_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'done' AS status,
       'C' || o_custkey AS credit_account_account_cbu, 7 AS credit_account_bank_number,
       '20' AS debit_account_customer_cuit, '55' AS debit_account_account_number,
       '***REDACTED***' AS shown_cuit
FROM orders
""")
def transfer_accounts_flatten(d: Data):
    return transfer_rows(d).select(
        "transfer_id", "request_date", "amount", "status", "credit_account_account_cbu",
        "credit_account_bank_number", "debit_account_customer_cuit", "debit_account_account_number",
        F.get_json_object("raw_json", "$.debit_account_customer_cuit").alias("shown_cuit"),
    )


@query("""
SELECT o_orderkey AS transfer_id,
       CASE o_orderstatus WHEN 'O' THEN 'x' END AS beyond,
       CASE o_orderstatus WHEN 'F' THEN 'free text' END AS scalar_text,
       CASE WHEN o_orderstatus = 'O' THEN CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS addenda_amount,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS addenda_operation_numer,
       CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2001-01-31' END AS addenda_due_date
FROM orders
""")
def blob_flatten(d: Data):
    is_object = F.col("addenda").startswith("{")
    return transfer_rows(d).select(
        "transfer_id", F.get_json_object("addenda", "$.beyond").alias("beyond"),
        F.when(~is_object, F.col("addenda")).alias("scalar_text"),
        "addenda_amount", "addenda_operation_numer", "addenda_due_date",
    )


VOUCHER_BODY = f"""to_json(named_struct('comprobantes', array(named_struct(
    'id', o_orderkey, 'importeTotal', CAST(o_totalprice AS DECIMAL(18,2)),
    'debit_account', named_struct('cuitContribuyente', '30', 'voucher_number', {S.PRIORITY}),
    'empresaFacturadora', named_struct('billing_company_cuit', '31', 'due_date', '2001-05-06'),
    'payingCustomer', named_struct('company_name', concat('co ', o_custkey), 'account_cuit', '32'),
    'datosAfip', named_struct('nroVep', o_orderkey, 'periodoFiscal', '200101', 'pagDesc', 'tax',
                              'control_code', o_custkey)))))"""


@query("""
SELECT o_orderkey AS transfer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
       '30' AS debit_account_taxpayer_cuit, substr(o_orderpriority, 1, 1) AS debit_account_voucher_number,
       '31' AS billing_company_billing_company_cuit, TIMESTAMP '2001-05-06' AS billing_company_due_date,
       'co ' || o_custkey AS paying_customer_company_name, CAST(o_orderkey AS VARCHAR) AS afip_vep_number,
       '200101' AS afip_fiscal_period, 'tax' AS afip_pago_desc,
       CAST(o_custkey AS VARCHAR) AS afip_control_code, '***REDACTED***' AS shown_cuit
FROM orders
""")
def voucher_flatten(d: Data):
    rows = normalize(
        bank.wire_rows(pages(d.orders, VOUCHER_BODY, "NULL"), "voucher"), "voucher"
    )
    return rows.select(
        "transfer_id", "total_amount", "debit_account_taxpayer_cuit", "debit_account_voucher_number",
        "billing_company_billing_company_cuit", "billing_company_due_date",
        "paying_customer_company_name", "afip_vep_number", "afip_fiscal_period", "afip_pago_desc",
        "afip_control_code",
        F.get_json_object("raw_json", "$.paying_customer_account_cuit").alias("shown_cuit"),
    )


@query("""
SELECT s_suppkey AS account, CAST(s_acctbal AS DOUBLE) AS owner_balance, n_name AS owner_bank
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def prefix_flatten(d: Data):
    owner = F.struct(F.col("s_acctbal").alias("balance"), F.col("n_name").alias("bank"))
    df = d.supplier.join(d.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return flatten.flatten_prefix(
        df.select(F.col("s_suppkey").alias("account"), owner.alias("nested")), "nested", "owner"
    )


# -- movements: normalisation and keys -----------------------------------------------
MOVEMENT_BODY = """concat('{"movements_detail":[', if(l_linestatus = 'O',
    to_json(named_struct('amount', CAST(l_extendedprice AS DECIMAL(18,2)), 'voucher_number', l_orderkey,
        'correlative_number', l_linenumber, 'process_date', date_format(l_shipdate, 'yyyy-MM-dd'),
        'debit_credit_type', l_returnflag, 'operation_code_ib', l_partkey, 'customer_cuit', '20-1')),
    to_json(named_struct('importe', CAST(l_extendedprice AS STRING), 'nroComprobante', CAST(l_orderkey AS DOUBLE),
        'correlativo', concat(' ', l_linenumber), 'fechaProceso', date_format(l_shipdate, "yyyy-MM-dd'T'00:00:00"),
        'tipoMovimiento', l_returnflag, 'codigoOperacionIB', l_partkey, 'cuitCliente', '20-1'))), ']}')"""

SQL_HASH_PARTS = """l_suppkey || '|' || l_orderkey || '|' || CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR) || '|'
    || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '|' || l_returnflag || '|' || l_partkey
    || '||' || l_linenumber"""


@query(f"""
SELECT sha256({SQL_HASH_PARTS}) AS movement_hash, CAST(l_suppkey AS VARCHAR) AS source_account,
       CAST(l_orderkey AS VARCHAR) AS voucher_number, CAST(l_linenumber AS VARCHAR) AS correlative_number,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       CAST(l_shipdate AS TIMESTAMP) AS process_date, 'anteriores' AS movement_source,
       'anteriores' AS movement_type, '20-1' AS customer_cuit, '***REDACTED***' AS shown_cuit
FROM lineitem
""")
def normalize_movements(d: Data):
    """Two spellings of the same movement give the same row and the same key."""
    landed = pages(d.lineitem, MOVEMENT_BODY, "l_suppkey", "'anteriores'")
    rows = normalize(bank.wire_rows(landed, "movement"), "movement", "anteriores")
    return rows.select(
        "movement_hash", "source_account", "voucher_number", "correlative_number", "amount",
        "process_date", "movement_source", "movement_type", "customer_cuit",
        F.get_json_object("raw_json", "$.customer_cuit").alias("shown_cuit"),
    )


@query(f"""
SELECT sha256({SQL_HASH_PARTS}) AS movement_hash,
       sha256(l_orderkey || '|' || l_suppkey || '|' || l_orderkey || '|' || CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR)
              || '|' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '|' || l_returnflag
              || '|' || l_linenumber) AS extract_hash,
       sha256(l_linenumber || '|' || l_suppkey || '|CC|ARS|' || CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR) || '||true|'
              || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) AS balance_hash
FROM lineitem
""")
def natural_key_hash(d: Data):
    rows = S.dealt(d.lineitem).selectExpr(
        "l_suppkey AS source_account", "l_orderkey AS voucher_number", "l_shipdate AS process_date",
        "CAST(l_extendedprice AS STRING) AS amount", "l_returnflag AS debit_credit_type",
        "l_partkey AS operation_code_ib", "CAST(NULL AS STRING) AS branch_office_activity",
        "l_linenumber AS correlative_number", "l_orderkey AS statement_number",
        "concat('0', l_linenumber) AS bank_number", "concat(l_suppkey, '.0') AS account_number",
        "'CC' AS account_type", "'ARS' AS currency", "l_shipdate AS row_date",
        "CAST(NULL AS STRING) AS operation_date", "'Yes' AS is_historical",
        "CAST(l_extendedprice AS STRING) AS day_balance",
    )
    rows = rows.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in rows.columns])
    return rows.selectExpr(
        f"{keys.movement_key()} AS movement_hash", f"{keys.extract_key()} AS extract_hash",
        f"{keys.balance_key()} AS balance_hash",
    )


@query("""
WITH m AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS source_account, date_trunc('year', l_shipdate) AS process_date,
           CAST(l_quantity AS DECIMAL(18,2)) AS amount, l_returnflag AS debit_credit_type,
           row_number() OVER (PARTITION BY l_suppkey, date_trunc('year', l_shipdate), l_quantity, l_returnflag
                              ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS seq
    FROM lineitem)
SELECT source_account, CAST(process_date AS TIMESTAMP) AS process_date, CAST(amount AS DOUBLE) AS amount,
       seq,
       sha256('dia|' || source_account || '|' || CAST(CAST(process_date AS TIMESTAMP) AS VARCHAR) || '|'
              || CAST(amount AS VARCHAR) || '|' || debit_credit_type || '|||||' || seq) AS movement_hash
FROM m
""")
def provisional_key(d: Data):
    """Same-day movements without numbers of their own: twins are told apart by arrival."""
    rows = S.dealt(d.lineitem).selectExpr(
        "CAST(l_suppkey AS STRING) AS source_account",
        "CAST(CAST(date_trunc('YEAR', l_shipdate) AS TIMESTAMP_NTZ) AS STRING) AS process_date",
        "CAST(l_quantity AS STRING) AS amount", "l_returnflag AS debit_credit_type",
        *[f"CAST(NULL AS STRING) AS {c}" for c in ("operation_code_ib", "branch_office_activity",
                                                   "voucher_number", "correlative_number")],
        "l_orderkey", "l_linenumber", "l_partkey",
    )
    block = F.floor(F.col("l_orderkey") / 100000)
    keyed = keys.provisional_key(rows, ["l_orderkey", "l_linenumber", "l_partkey"], block)
    return keyed.select(
        "source_account", F.col("process_date").cast("timestamp_ntz").alias("process_date"),
        F.col("amount").cast("double").alias("amount"), "seq", "movement_hash",
    )


@query("""
SELECT CAST(l_suppkey AS VARCHAR) AS source_account, 'dia' AS movement_source,
       CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS TIMESTAMP) ELSE TIMESTAMP '2002-01-01' END AS movement_date,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM lineitem
""")
def same_day_rows(d: Data):
    """The same-day feed: no movement date, so process date or now stands in."""
    body = """concat('[', to_json(named_struct('amount', CAST(l_extendedprice AS DECIMAL(18,2)),
        'process_date', if(l_linestatus = 'O', date_format(l_shipdate, 'yyyy-MM-dd'), NULL))), ']')"""
    rows = bank.wire_rows(pages(d.lineitem, body, "l_suppkey", "'dia'"), "movement")
    rows = normalize(rows, "movement", "dia", S.lit_ts(AS_OF), ["ordinal"], bank.arrival_block())
    return rows.select("source_account", "movement_source", "movement_date", "amount")


# -- scalars -----------------------------------------------------------------------
TOKENS = ("1", "true", " T ", "Yes", "si", "SÍ", "0", "False", "f", "NO", "maybe", "")


@query(f"""
SELECT event_id,
       CASE WHEN k % 12 < 6 THEN TRUE WHEN k % 12 < 10 THEN FALSE END AS flag,
       CASE WHEN k % 3 = 0 THEN NULL ELSE k % 3 = 1 END AS number_flag
FROM (SELECT event_id, {S.SQL_K} AS k FROM events)
""")
def to_bool_tokens(d: Data):
    token = F.element_at(F.array(*[F.lit(t) for t in TOKENS]), S.k() % len(TOKENS) + 1)
    number = F.when(S.k() % 3 == 0, F.lit(float("nan"))).when(S.k() % 3 == 1, -2.0).otherwise(0.0)
    return d.events.select(
        "event_id", X.to_bool(token).alias("flag"), X.number_to_bool(number).alias("number_flag")
    )


@query("""
SELECT doc_id, trim(text, chr(9) || chr(10) || chr(13) || ' ') AS cleaned,
       nullif(trim(lang, ' '), '') AS lang, CAST(NULL AS VARCHAR) AS blank,
       CAST(n_chars AS VARCHAR) AS id_text, CAST(doc_id AS VARCHAR) AS float_id, '0' AS zero
FROM documents
""")
def clean_strings(d: Data):
    padded = F.concat(F.lit(" \t \n"), F.col("text"), F.lit(" \r\n "))
    return d.documents.select(
        "doc_id", X.clean(padded).alias("cleaned"),
        X.clean(F.concat(F.lit(" "), F.col("lang"))).alias("lang"),
        X.clean(F.lit(" 　\t")).alias("blank"), X.to_str(F.col("n_chars")).alias("id_text"),
        X.to_str(F.concat(F.col("doc_id"), F.lit(".0"))).alias("float_id"),
        X.to_str(F.lit(0)).alias("zero"),
    )


@query("""
SELECT event_id, date_trunc('second', ts) AS dropped,
       date_trunc('second', ts) + INTERVAL 4 HOUR AS shifted,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_text, CAST(NULL AS TIMESTAMP) AS unreadable
FROM events
""")
def parse_ts(d: Data):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zoned = F.concat(text, F.lit("-04:00"))
    day = F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "MM/dd/yyyy")
    )
    return d.events.select(
        "event_id", X.parse_ts_drop_zone(zoned).alias("dropped"), X.parse_ts_utc(zoned).alias("shifted"),
        X.parse_ts_drop_zone(day).alias("day_text"),
        X.parse_ts_drop_zone(F.lit("soon")).alias("unreadable"),
    )


@query("""
SELECT s_suppkey, '***REDACTED***' AS account_cuit,
       CASE WHEN s_nationkey < 10 THEN '***REDACTED***' END AS customer_cuit, s_acctbal AS amount
FROM supplier
""")
def redact_bank(d: Data):
    return mask(
        d.supplier.selectExpr(
            "s_suppkey", "s_name AS account_cuit", "if(s_nationkey < 10, s_name, NULL) AS customer_cuit",
            "s_acctbal AS amount",
        )
    )


# -- reports, filters, audits ---------------------------------------------------------
@query(f"""
SELECT source_account, voucher_number, correlative_number, process_date, CAST(amount AS DOUBLE) AS amount
FROM ({S.SQL_MOVEMENTS})
WHERE source_account = '7' AND process_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-12-31'
""")
def movements_by_account(d: Data):
    rows = reports.movements_by_account(S.movements(d.lineitem), "7", "1998-01-01", "2000-12-31")
    return rows.select("source_account", "voucher_number", "correlative_number", "process_date", "amount")


@query(f"""
SELECT source_account, operation_code_ib, process_date, CAST(amount AS DOUBLE) AS amount
FROM ({S.SQL_MOVEMENTS}) WHERE process_date BETWEEN TIMESTAMP '1999-06-01' AND TIMESTAMP '1999-06-30'
""")
def movements_by_date(d: Data):
    rows = reports.movements_by_date(S.movements(d.lineitem), "1999-06-01", "1999-06-30")
    return rows.select("source_account", "operation_code_ib", "process_date", "amount")


@query(f"""
SELECT source_account, voucher_number, correlative_number, operation_code_ib, process_date
FROM ({S.SQL_MOVEMENTS})
ORDER BY process_date DESC, voucher_number || '-' || correlative_number || '-' || operation_code_ib DESC LIMIT 10
""")
def latest_movements(d: Data):
    rows = S.movements(d.lineitem).withColumn(
        "movement_id", F.concat_ws("-", "voucher_number", "correlative_number", "operation_code_ib")
    )
    return reports.latest_movements(rows).select(
        "source_account", "voucher_number", "correlative_number", "operation_code_ib", "process_date"
    )


@query(f"""
SELECT coalesce(movement_source, '(NULL)') AS movement_source, count(*) AS rows
FROM ({S.SQL_MOVEMENTS}) GROUP BY 1
""")
def provenance_split(d: Data):
    return reports.provenance_split(S.movements(d.lineitem))


@query(f"""
SELECT source_account, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS amount
FROM ({S.SQL_MOVEMENTS}) WHERE movement_source IS DISTINCT FROM 'dia' GROUP BY 1
""")
def settled_movements(d: Data):
    """Movements that are not same-day rows; an unlabelled one is settled."""
    rows = S.movements(d.lineitem).where(filters.settled_only())
    return rows.groupBy("source_account").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount")
    )


@query(f"""
SELECT coalesce(movement_source, 'anteriores') AS movement_source, count(*) AS rows
FROM ({S.SQL_MOVEMENTS}) GROUP BY 1
""")
def backfill_null(d: Data):
    rows = mutate.backfill_null(S.movements(d.lineitem), "movement_source", "anteriores")
    return reports.provenance_split(rows)


@query(f"""
WITH m AS (SELECT *, CASE debit_credit_type WHEN 'A' THEN 'anteriores' WHEN 'N' THEN 'dia' ELSE 'diferidos' END AS kind,
                  CASE WHEN movement_source = 'dia' THEN 'CA' ELSE 'CC' END AS account_type
           FROM ({S.SQL_MOVEMENTS}))
SELECT kind AS movement_type, source_account, process_date, CAST(amount AS DOUBLE) AS amount FROM m
WHERE account_type = 'CC' AND (kind = 'dia' OR (kind = 'anteriores'
      AND process_date BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'))
""")
def request_filters(d: Data):
    """One movement request per kind; only the same-day one ignores the window."""
    rows = S.movements(d.lineitem).withColumns(
        {
            "movement_type": F.when(F.col("debit_credit_type") == "A", "anteriores")
            .when(F.col("debit_credit_type") == "N", "dia").otherwise("diferidos"),
            "account_type": F.when(F.col("movement_source").eqNullSafe("dia"), "CA").otherwise("CC"),
            "currency": F.lit("ARS"),
        }
    )
    window = {"begin": S.lit_ts("1999-01-01"), "end": S.lit_ts("1999-12-31")}
    both = [filters.request_filter(rows, kind, **window) for kind in ("anteriores", "dia")]
    return both[0].unionByName(both[1]).select("movement_type", "source_account", "process_date", "amount")


@query("""
SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS account_number, 'ARS' AS currency, 'CC' AS account_type,
       n_name AS bank_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def account_list(d: Data):
    accounts = accounts_table(d)
    return reports.account_list(accounts).withColumn("s_suppkey", F.col("account_number").cast("bigint"))


def accounts_table(d: Data) -> DataFrame:
    return d.supplier.join(d.nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "CAST(s_suppkey AS STRING) AS account_number", "n_name AS bank_name", "'ARS' AS currency",
        "'CC' AS account_type",
    )


@query(f"""
SELECT source_account, count(*) AS rows FROM ({S.SQL_MOVEMENTS})
WHERE source_account IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 5000)
GROUP BY 1
""")
def account_subset(d: Data):
    chosen = d.supplier.where("s_acctbal > 5000").selectExpr("CAST(s_suppkey AS STRING) AS source_account")
    rows = filters.account_subset(S.movements(d.lineitem), chosen, "source_account")
    return rows.groupBy("source_account").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""
SELECT 'month' AS preset, count(*) AS rows FROM ({S.SQL_MOVEMENTS}) WHERE process_date >= TIMESTAMP '2000-06-01' AND process_date < TIMESTAMP '2000-06-21'
UNION ALL
SELECT '7d', count(*) FROM ({S.SQL_MOVEMENTS}) WHERE process_date >= TIMESTAMP '2000-06-13' AND process_date < TIMESTAMP '2000-06-21'
UNION ALL
SELECT '30d', count(*) FROM ({S.SQL_MOVEMENTS}) WHERE process_date >= TIMESTAMP '2000-05-21' AND process_date < TIMESTAMP '2000-06-21'
""")
def date_presets(d: Data):
    rows, today = S.movements(d.lineitem), dt.date(2000, 6, 20)
    parts = [
        filters.in_preset(rows, "process_date", p, today)
        .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(p).alias("preset"), "rows")
        for p in ("month", "7d", "30d")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS account_number, n_name AS bank_name, 'ARS' AS currency,
       (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey
          AND l_shipdate BETWEEN TIMESTAMP '2000-04-02' AND TIMESTAMP '2000-07-01') AS movements,
       (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS balances,
       (SELECT count(*) FROM orders WHERE o_custkey = s_suppkey
          AND o_orderdate BETWEEN TIMESTAMP '2000-04-02' AND TIMESTAMP '2000-07-01') AS extracts
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def availability_matrix(d: Data):
    moves = S.movements(d.lineitem)
    extracts = d.orders.selectExpr("CAST(o_custkey AS STRING) AS source_account", "o_orderdate AS operation_date")
    datasets = {
        "movements": (moves, "source_account", "process_date"),
        "balances": (moves.where("debit_credit_type = 'R'"), "source_account", None),
        "extracts": (extracts, "source_account", "operation_date"),
    }
    return reports.availability_matrix(accounts_table(d), datasets, dt.date(2000, 7, 1))


@query("""
SELECT 'mp_payments' AS table_name, count(*) AS rows FROM orders
UNION ALL SELECT 'ib_movements', count(*) FROM lineitem
UNION ALL SELECT 'ib_accounts', count(*) FROM supplier
UNION ALL SELECT 'ib_balances', count(*) FROM customer
UNION ALL SELECT 'sync_runs', count(*) FROM events
""")
def table_counts(d: Data):
    return audit.table_counts(
        {"mp_payments": d.orders, "ib_movements": d.lineitem, "ib_accounts": d.supplier,
         "ib_balances": d.customer, "sync_runs": d.events}
    )


@query("""
WITH pay AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'),
     tr AS (SELECT o_orderkey AS id, o_custkey || '-' || o_orderpriority AS num FROM orders WHERE o_orderstatus <> 'F'),
     v AS (SELECT o_orderkey AS id FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01')
SELECT 'mp_payments' AS table_name, 'unique' AS rule, 'payment_id' AS columns, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'mp_payments', 'not_null', 'payment_id', 0
UNION ALL SELECT 'mp_payment_charges', 'unique', 'payment_id,charge_id',
    CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_linenumber)) AS BIGINT)
UNION ALL SELECT 'mp_payment_charges', 'not_null', 'payment_id', 0
UNION ALL SELECT 'mp_payment_charges', 'not_null', 'charge_id', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N')
UNION ALL SELECT 'mp_payment_charges', 'foreign_key', 'payment_id',
    (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT id FROM pay))
UNION ALL SELECT 'ib_transfers', 'unique', 'transfer_id', 0
UNION ALL SELECT 'ib_transfers', 'unique', 'transaction_number',
    CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM tr GROUP BY num)) AS BIGINT)
UNION ALL SELECT 'ib_transfers', 'not_null', 'transfer_id', 0
UNION ALL SELECT 'ib_vouchers', 'unique', 'transfer_id', 0
UNION ALL SELECT 'ib_vouchers', 'not_null', 'transfer_id', 0
UNION ALL SELECT 'ib_vouchers', 'foreign_key', 'transfer_id', (SELECT count(*) FROM v WHERE id NOT IN (SELECT id FROM tr))
""")
def constraint_violations(d: Data):
    tables = {
        "mp_payments": d.orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey AS payment_id"),
        "mp_payment_charges": d.lineitem.selectExpr(
            "l_orderkey AS payment_id",
            "if(l_returnflag = 'N', NULL, CAST(l_linenumber AS STRING)) AS charge_id",
        ),
        "ib_transfers": d.orders.where("o_orderstatus <> 'F'").selectExpr(
            "o_orderkey AS transfer_id", "concat(o_custkey, '-', o_orderpriority) AS transaction_number"
        ),
        "ib_vouchers": d.orders.where("o_orderdate > '2000-01-01'").selectExpr("o_orderkey AS transfer_id"),
    }
    return audit.audit_constraints(tables)


@query("""
SELECT 'text' AS column_name, 4000 AS width, CAST(max(length(text)) AS INTEGER) AS max_length,
       count(*) FILTER (WHERE length(text) > 4000) AS too_long FROM documents
UNION ALL SELECT 'lang', 2, CAST(max(length(lang)) AS INTEGER), count(*) FILTER (WHERE length(lang) > 2) FROM documents
UNION ALL SELECT 'source', 3, CAST(max(length(source)) AS INTEGER), count(*) FILTER (WHERE length(source) > 3) FROM documents
""")
def width_audit(d: Data):
    return audit.audit_widths(d.documents, {"text": 4000, "lang": 2, "source": 3})


@query("""
WITH t AS (SELECT o_orderkey AS movement_hash, CAST(o_custkey AS VARCHAR) AS source_account,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                  CASE o_orderstatus WHEN 'O' THEN 'dia' WHEN 'F' THEN 'anteriores' END AS movement_source
           FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
     c AS (SELECT o_orderkey AS movement_hash, CAST(o_custkey AS VARCHAR) AS source_account,
                  CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS amount
           FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1998-01-01' AND c_mktsegment <> 'MACHINERY'),
     ok AS (SELECT CAST(c_custkey AS VARCHAR) AS a FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT movement_hash, source_account, CAST(amount AS DOUBLE) AS amount, movement_source
FROM t WHERE movement_source IS DISTINCT FROM 'dia'
UNION ALL
SELECT movement_hash, source_account, CAST(amount AS DOUBLE), 'dia' FROM c
UNION ALL
SELECT movement_hash, source_account, CAST(amount AS DOUBLE), 'dia' FROM t
WHERE movement_source = 'dia' AND source_account NOT IN (SELECT a FROM ok)
  AND movement_hash NOT IN (SELECT movement_hash FROM c)
""")
def reconcile_snapshot(d: Data):
    """Same-day rows follow the feed; accounts whose feed failed keep theirs."""
    rows = d.orders.selectExpr(
        "o_orderkey AS movement_hash", "CAST(o_custkey AS STRING) AS source_account",
        f"CAST(o_totalprice AS {S.MONEY}) AS amount",
        "CASE o_orderstatus WHEN 'O' THEN 'dia' WHEN 'F' THEN 'anteriores' END AS movement_source",
        "o_orderdate",
    )
    fetched = d.customer.where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "CAST(c_custkey AS STRING) AS source_account"
    )
    stored = rows.where("o_orderdate < '2000-01-01'").drop("o_orderdate")
    feed = rows.where("movement_source = 'dia' AND o_orderdate >= '1998-01-01'").join(
        fetched, "source_account", "left_semi"
    ).withColumn("amount", (F.col("amount") + 1).cast(S.MONEY))
    return mutate.reconcile_snapshot(
        stored, feed, ["movement_hash"], ["source_account", "amount", "movement_source"],
        S.lit_ts(AS_OF), scope=fetched,
    )
