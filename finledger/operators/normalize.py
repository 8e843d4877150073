"""From wire text to typed, keyed rows of the bank tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.functions.redact import bank_raw_json
from finledger.functions.scalars import (
    clean,
    parse_ts_drop_zone,
    read_as,
    read_id,
    to_bool,
    to_str,
)
from finledger.operators.keys import balance_key, extract_key, movement_key, provisional_key
from finledger.schemas import SPECS
from finledger.sources.conform import conform

TABLE_OF = {
    "account": "ib_accounts",
    "balance": "ib_balances",
    "movement": "ib_movements",
    "transfer": "ib_transfers",
    "voucher": "ib_vouchers",
    "extract": "ib_extracts",
}

# Text columns that hold identifiers and may arrive as numbers.
ID_COLUMNS = {
    "account": ("account_number",),
    "balance": ("account_number",),
    "movement": (
        "voucher_number", "branch_office_activity", "source_account", "associated_voucher",
        "correlative_number", "grouping_code_standard", "operation_code_standard",
    ),
    "transfer": (
        "transaction_number", "reference_number", "lot_number", "payment_number",
        "credit_account_account_number", "debit_account_account_number",
        "addenda_operation_numer", "addenda_payment_receipt", "addenda_seller_tax_id",
        "addenda_voucher_type", "addenda_community_code", "addenda_seller_code",
        "addenda_sale_point", "addenda_voucher_number",
    ),
    "voucher": (
        "network_number", "afip_control_code", "afip_nro_formulario", "afip_fee_number",
        "afip_concept_code", "afip_tax_code", "afip_vep_number", "afip_fiscal_period",
        "afip_provider_code", "debit_account_voucher_number",
        "billing_company_billing_company_cuit", "billing_company_billing_account_id",
        "paying_customer_voucher_number", "paying_customer_linkage_code",
        "paying_customer_account_cuit", "paying_customer_account_cbu",
        "paying_customer_customer_cuit",
    ),
    "extract": (
        "statement_number", "voucher_number", "grouping_code_ib", "branch_office_activity",
        "correlative_number", "source_account",
    ),
}


def typed(c: str, dtype: T.DataType, is_id: bool = False) -> str:
    """SQL text: wire text as the target type; what cannot be read becomes NULL."""
    if isinstance(dtype, T.StringType):
        return to_str(c) if is_id else clean(c)
    if isinstance(dtype, T.TimestampNTZType):
        return parse_ts_drop_zone(c)
    if isinstance(dtype, T.BooleanType):
        return to_bool(c)
    if isinstance(dtype, T.DecimalType):
        return read_as(c, dtype.simpleString())
    return read_id(c, dtype.simpleString())


def normalize(
    df: DataFrame, dataset: str, feed: str | None = None, as_of: Column | None = None,
    order: Sequence[str | Column] = (), block: Column | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Typed rows with natural key and redacted ``raw_json``, in table column order.

    ``feed`` names the movement feed. The same-day feed ``dia`` needs the arrival
    ``order`` (and its ``block``), and its movements without a date take the process
    date, else ``as_of``. ``keep`` lists further columns to carry through.
    """
    spec = SPECS[TABLE_OF[dataset]]
    schema = spec.schema
    ids = set(ID_COLUMNS[dataset])
    payload = [c for c in spec.update_cols if c not in ("raw_json", "movement_source")]
    natural = [k for k in spec.keys if not k.endswith("_hash")]
    extra = [c for c in keep if c not in payload and c not in natural]
    if dataset == "movement" and "account_number" in df.columns:
        extra.append("account_number")  # traced in raw_json only
    carried = df.select(*extra).schema.fields if extra else []
    extra_order = [f"__o{i}" for i in range(len(order))]
    df = df.withColumns(
        {n: (F.col(c) if isinstance(c, str) else c) for n, c in zip(extra_order, order)}
    )
    if block is not None:
        df = df.withColumn("__b", block)
        extra_order.append("__b")
    wire = T.StructType([T.StructField(n, T.StringType()) for n in natural + payload] + carried)
    ordered = df.select(*extra_order).schema.fields if extra_order else []
    df = conform(df, T.StructType(wire.fields + ordered))

    if dataset == "movement" and feed == "dia":
        df = provisional_key(df, extra_order[:-1], F.col("__b")).drop("seq")
    elif dataset == "movement":
        df = df.withColumn("movement_hash", F.expr(movement_key()))
    elif dataset == "balance":
        df = df.withColumn("balance_hash", F.expr(balance_key()))
    elif dataset == "extract":
        df = df.withColumn("extract_hash", F.expr(extract_key()))

    columns = {c: typed(c, schema[c].dataType, c in ids) for c in natural + payload}
    if dataset == "movement":
        columns["movement_source"] = f"'{feed}'"
        if feed == "dia":
            df = df.withColumn("__as_of", as_of)
            columns["movement_date"] = (
                f"coalesce({columns['movement_date']}, {columns['process_date']}, __as_of)"
            )
    hashes = [k for k in spec.keys if k.endswith("_hash")]
    df = df.selectExpr(*extra, *hashes, *[f"{v} AS {c}" for c, v in columns.items()])
    shown = [c for c in df.columns if c not in keep or c in payload]
    return df.selectExpr(
        *spec.keys, *[c for c in spec.update_cols if c != "raw_json"],
        f"{bank_raw_json(shown)} AS raw_json", *[c for c in keep if c in extra],
    ).select(*spec.keys, *spec.update_cols, *[c for c in keep if c in extra])
