"""Nested records to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.functions.redact import redact_payment
from finledger.functions.scalars import first_nonzero, parse_ts_drop_zone, read_id, to_str
from finledger.schemas import SPECS
from finledger.sources import aliases as A
from finledger.sources.conform import rename_fields


def flatten_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Members of a struct column as ``prefix_member`` columns; the struct goes away."""
    members = df.schema[col].dataType.names
    return df.select(
        *[c for c in df.columns if c != col],
        *[F.col(col)[m].alias(f"{prefix}_{m}") for m in members],
    )


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def _members(nested: Sequence[str], dataset: str, prefix: str) -> list[str]:
    """SQL text of each member: the first name that holds a value in the first object."""
    return [
        "coalesce(" + ", ".join(f"{o}.`{n}`" for o in nested for n in (name, *others))
        + f") AS `{prefix}_{name}`"
        for name, others in A.alias_map(dataset).items()
    ]


def flatten_account(df: DataFrame, prefix: str, *sources: str, dataset: str = "nested_account") -> DataFrame:
    """The first of the source objects that is there, as ``prefix_*`` columns."""
    found = _present(df, sources)
    if not found:
        return df
    one = f"coalesce({', '.join(found)})"
    df = df.selectExpr(*[f"`{c}`" for c in df.columns if c not in found], f"{one} AS __nested")
    return df.selectExpr("*", *_members(["__nested"], dataset, prefix)).drop("__nested")


def flatten_blob(df: DataFrame, prefix: str, fields: Sequence[str], *sources: str) -> DataFrame:
    """Members as ``prefix_*`` columns, and the whole object kept as JSON text.

    Sources are VARIANT, so members outside ``fields`` survive in the kept text. A
    scalar stays as it is and yields no members.
    """
    found = _present(df, sources)
    if not found:
        return df
    text = f"try_variant_get(coalesce({', '.join(found)}), '$', 'string')"
    schema = ", ".join(
        f"{n} {'DECIMAL(38,10)' if n == 'amount' else 'STRING'}" for n in fields
    )
    rest = [f"`{c}`" for c in df.columns if c not in found]
    df = df.selectExpr(*rest, f"{text} AS `{prefix}`")
    df = df.selectExpr("*", f"from_json(`{prefix}`, '{schema}') AS __parsed")
    return df.selectExpr("*", *[f"__parsed.`{n}` AS `{prefix}_{n}`" for n in fields]).drop("__parsed")


def transfers(df: DataFrame) -> DataFrame:
    """Transfer records: credit and debit account and addenda flattened, names folded."""
    df = flatten_account(df, "credit_account", *A.CREDIT_NAMES)
    df = flatten_account(df, "debit_account", *A.DEBIT_NAMES)
    df = flatten_blob(df, "addenda", A.ADDENDA_FIELDS, *A.ADDENDA_NAMES)
    return rename_fields(df, A.alias_map("transfer"))


def vouchers(df: DataFrame) -> DataFrame:
    """Voucher records: accounts, billing company, paying customer and tax block flattened."""
    df = flatten_account(df, "credit_account", *A.CREDIT_NAMES)
    df = flatten_account(df, "debit_account", *A.DEBIT_NAMES)
    df = flatten_blob(df, "billing_company", A.BILLING_FIELDS, *A.BILLING_NAMES)
    df = flatten_blob(df, "paying_customer", A.PAYING_FIELDS, *A.PAYING_NAMES)
    df = flatten_account(df, "afip", *A.TAX_NAMES, dataset="tax_block")
    return rename_fields(df, A.alias_map("voucher"))


def balances(df: DataFrame) -> DataFrame:
    """One row for the account's current balance and one more per historical balance.

    Both kinds come out of a single explode, so each record is read and parsed once.
    """
    past = F.coalesce(F.col("historical_balances"), F.array())
    past = F.filter(past, lambda h: h.isNotNull())
    none = F.lit(None).cast(df.schema["historical_balances"].dataType.elementType)
    tagged = F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("flag"), none.alias("h"))),
        F.transform(past, lambda h: F.struct(F.lit("true").alias("flag"), h.alias("h"))),
    )
    now = df.schema["balances"].dataType.names
    names = ("operation_date", "day_balance", "total_debits", "total_credits")
    fixed = {"balances", "historical_balances", "is_historical", *now, *names}
    out = df.withColumn("__row", F.explode(tagged)).selectExpr(
        *[f"`{c}`" for c in df.columns if c not in fixed],
        *[f"balances.`{n}` AS `{n}`" for n in now],
        *[f"__row.h.`{n}` AS `{n}`" for n in names],
        "__row.flag AS is_historical",
    )
    return rename_fields(out, A.alias_map("balance"))


def statements(df: DataFrame) -> DataFrame:
    """One row per statement movement with the header copied; the header alone if none.

    The movement's own value wins over the header's.
    """
    header = ("statement_number", "operation_date", "total_movements", "opening_balance",
              "ending_balance")
    first, second = F.col("movement_detail"), F.col("movements_detail")
    detail = F.coalesce(F.when(F.size(first) > 0, first), second)
    element = df.schema["movement_detail"].dataType.elementType
    alone = F.array(F.lit(None).cast(element))
    rows = F.when(F.size(detail) > 0, F.filter(detail, lambda m: m.isNotNull())).otherwise(alone)
    out = df.withColumn("__mov", F.explode(rows))
    names = element.names
    carried = [c for c in df.columns
               if c not in names and c not in ("movement_detail", "movements_detail")]
    out = out.selectExpr(
        *carried,
        *[(f"coalesce(__mov.`{n}`, `{n}`)" if n in header else f"__mov.`{n}`") + f" AS `{n}`"
          for n in names],
    )
    return rename_fields(out, A.alias_map("extract"))


def inject_request_params(df: DataFrame, **columns: Column) -> DataFrame:
    """Values the request knows and the record does not; they replace the record's own."""
    return df.withColumns(columns)


# ---------------------------------------------------------------------------
# Payments
# ---------------------------------------------------------------------------
_S, _B = "STRING", "BOOLEAN"
_M = "DECIMAL(18,2)"
_IDENT = "identification:STRUCT<type:STRING, number:STRING>"

PAYMENT_RECORD = f"""
    id {_S}, collector_id {_S}, collector STRUCT<id:{_S}>, payer_id {_S},
    payer STRUCT<id:{_S}, email:{_S}, {_IDENT}>,
    external_reference {_S}, `order` STRUCT<id:{_S}, type:{_S}>, status {_S}, status_detail {_S},
    operation_type {_S}, payment_method_id {_S}, payment_type_id {_S},
    payment_method STRUCT<type:{_S}>, issuer_id {_S}, currency_id {_S}, installments INT,
    transaction_amount {_M}, transaction_amount_refunded {_M}, shipping_amount {_M},
    shipping_cost {_M}, taxes_amount {_M}, coupon_amount {_M},
    transaction_details STRUCT<net_received_amount:{_M}, total_paid_amount:{_M},
        installment_amount:{_M}, overpaid_amount:{_M}>,
    description {_S}, authorization_code {_S}, money_release_status {_S}, binary_mode {_B},
    captured {_B}, live_mode {_B}, store_id {_S}, pos_id {_S}, notification_url {_S},
    statement_descriptor {_S}, processing_mode {_S},
    point_of_interaction STRUCT<type:{_S},
        business_info:STRUCT<unit:{_S}, sub_unit:{_S}, branch:{_S}>,
        location:STRUCT<source:{_S}, state_id:{_S}>>,
    card STRUCT<first_six_digits:{_S}, last_four_digits:{_S},
        cardholder:STRUCT<name:{_S}, {_IDENT}>>,
    date_created {_S}, date_approved {_S}, date_last_updated {_S}, money_release_date {_S}
"""

ITEMS_RECORD = f"""
    id {_S},
    additional_info STRUCT<items:ARRAY<STRUCT<id:{_S}, category_id:{_S}, title:{_S},
        description:{_S}, quantity:DECIMAL(18,4), unit_price:{_M}, picture_url:{_S}>>>
"""

CHARGES_RECORD = f"""
    id {_S},
    charges_details ARRAY<STRUCT<id:{_S}, type:{_S}, name:{_S},
        accounts:STRUCT<`from`:{_S}, `to`:{_S}>, amounts:STRUCT<original:{_M}, refunded:{_M}>,
        base_amount:{_M}, rate:DECIMAL(18,6), reserve_id:{_S}, client_id:{_S},
        metadata:STRUCT<tax_id:{_S}, tax_status:{_S}, mov_detail:{_S},
            mov_financial_entity:{_S}, mov_type:{_S}, user_id:{_S}, source:{_S}>,
        date_created:{_S}, last_updated:{_S}>>
"""

# Where the columns that are not top-level members of the same name come from.
_NESTED_FROM = {
    "order_id": "order.id",
    "order_type": "order.type",
    "payment_method_type": "payment_method.type",
    "net_received_amount": "transaction_details.net_received_amount",
    "total_paid_amount": "transaction_details.total_paid_amount",
    "installment_amount": "transaction_details.installment_amount",
    "overpaid_amount": "transaction_details.overpaid_amount",
    "point_type": "point_of_interaction.type",
    "point_unit": "point_of_interaction.business_info.unit",
    "point_sub_unit": "point_of_interaction.business_info.sub_unit",
    "point_branch": "point_of_interaction.business_info.branch",
    "point_source": "point_of_interaction.location.source",
    "point_state_id": "point_of_interaction.location.state_id",
    "payer_email": "payer.email",
    "payer_identification_type": "payer.identification.type",
    "payer_identification_number": "payer.identification.number",
    "card_first_six_digits": "card.first_six_digits",
    "card_last_four_digits": "card.last_four_digits",
    "cardholder_name": "card.cardholder.name",
    "cardholder_ident_type": "card.cardholder.identification.type",
    "cardholder_ident_number": "card.cardholder.identification.number",
}


def payment_parent(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per payment document with the columns of the payments table."""
    df = df.withColumn("p", F.from_json(F.col(body), PAYMENT_RECORD))
    spec = SPECS["mp_payments"]
    special = {
        "collector_id": first_nonzero(read_id("p.collector_id"), read_id("p.collector.id")),
        "payer_id": first_nonzero(read_id("p.payer_id"), read_id("p.payer.id")),
        "raw_json": redact_payment(body),
    }
    out = [f"{read_id('p.id')} AS payment_id"]
    for name in spec.update_cols:
        value = special.get(name) or f"p.{_NESTED_FROM.get(name, name)}".replace(".order.", ".`order`.")
        if isinstance(spec.schema[name].dataType, T.TimestampNTZType):
            value = parse_ts_drop_zone(value)
        out.append(f"{value} AS {name}")
    return df.selectExpr(*keep, *out)


def _entries(df: DataFrame, body: str, keep: Sequence[str], schema: str, array: str, alias: str) -> DataFrame:
    """Payment id and one row per entry of an array in the document.

    Only what is needed is parsed, and only once: the outer explode keeps Catalyst from
    testing the array in a filter below, which would parse each document again.
    """
    df = df.withColumn("p", F.from_json(F.col(body), schema))
    rows = df.selectExpr(
        *keep, f"{read_id('p.id')} AS payment_id", f"explode_outer(p.{array}) AS {alias}"
    )
    return rows.where(F.col(alias).isNotNull())


def payment_charges(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of ``charges_details``."""
    df = _entries(df, body, keep, CHARGES_RECORD, "charges_details", "c")
    return df.selectExpr(
        *keep,
        "payment_id",
        f"{to_str('c.id')} AS charge_id",
        "c.type AS charge_type",
        "c.name AS charge_name",
        "c.accounts.`from` AS account_from",
        "c.accounts.`to` AS account_to",
        "c.amounts.original AS amount_original",
        "c.amounts.refunded AS amount_refunded",
        "c.base_amount",
        "c.rate",
        f"{read_id('c.reserve_id')} AS reserve_id",
        f"{read_id('c.client_id')} AS client_id",
        f"{read_id('c.metadata.tax_id')} AS tax_id",
        "c.metadata.tax_status",
        "c.metadata.mov_detail",
        "c.metadata.mov_financial_entity",
        "c.metadata.mov_type",
        f"{read_id('c.metadata.user_id')} AS metadata_user_id",
        "c.metadata.source AS metadata_source",
        f"{parse_ts_drop_zone('c.date_created')} AS charge_date_created",
        f"{parse_ts_drop_zone('c.last_updated')} AS charge_last_updated",
    )


def payment_items(df: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of ``additional_info.items``."""
    df = _entries(df, body, keep, ITEMS_RECORD, "additional_info.items", "i")
    return df.selectExpr(
        *keep,
        "payment_id",
        f"{to_str('i.id')} AS item_id",
        f"{to_str('i.category_id')} AS category_id",
        "i.title",
        "i.description",
        "i.quantity",
        "i.unit_price",
        "i.picture_url",
    )
