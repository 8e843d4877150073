"""Personal-data redaction by exact path, on whole JSON documents of any shape.

Documents travel as VARIANT, so members this library does not know about survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "***REDACTED***"

# Members of a payment document that are never kept in raw JSON.
PAYMENT_PATHS = (
    "payer.email", "payer.phone", "payer.first_name", "payer.last_name",
    "payer.identification.number", "payer.address",
    "card.first_six_digits", "card.last_four_digits",
    "card.cardholder.name", "card.cardholder.identification.number",
    "additional_info.payer", "additional_info.shipments.receiver_address",
    "metadata",
)

# Bank columns that are masked in raw JSON.
BANK_COLUMNS = (
    "account_cuit", "customer_cuit", "credit_account_customer_cuit",
    "debit_account_customer_cuit", "debit_account_taxpayer_cuit", "addenda_seller_tax_id",
    "billing_company_billing_company_cuit", "paying_customer_account_cuit",
    "paying_customer_customer_cuit",
)


def _tree(paths: tuple[str, ...]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for name in path.split("."):
            node = node.setdefault(name, {})
    return root


def _redact_object(v: str, tree: dict, depth: int = 0) -> str:
    """Redact the members named in ``tree``; anything that is not an object passes through."""
    key, value = f"k{depth}", f"x{depth}"
    cases = []
    for name, below in tree.items():
        new = _redact_object(value, below, depth + 1) if below else f"CAST('{MARKER}' AS VARIANT)"
        cases.append(
            f"WHEN {key} = '{name}' AND {value} IS NOT NULL AND NOT is_variant_null({value}) THEN {new}"
        )
    fields = f"try_variant_get({v}, '$', 'map<string,variant>')"
    member = f"({key}, {value}) -> CASE {' '.join(cases)} ELSE {value} END"
    return f"coalesce(to_variant_object(transform_values({fields}, {member})), {v})"


def redact_variant(v: str, paths: tuple[str, ...] = PAYMENT_PATHS) -> str:
    """SQL text: the variant ``v`` (a column name or SQL text) redacted."""
    return _redact_object(v, _tree(paths))


def redact_array(v: str, paths: tuple[str, ...] = PAYMENT_PATHS) -> str:
    """SQL text: each object of a JSON array redacted; other elements unchanged, NULL if
    ``v`` is no array."""
    items = f"try_variant_get({v}, '$', 'array<variant>')"
    return f"to_variant_object(transform({items}, item -> {redact_variant('item', paths)}))"


def redact_payment(body: str, paths: tuple[str, ...] = PAYMENT_PATHS) -> str:
    """SQL text: the JSON text ``body`` redacted; text that is not JSON becomes NULL."""
    redacted = f"to_json(coalesce({redact_array('doc', paths)}, {redact_variant('doc', paths)}))"
    # the one-element array makes the text be parsed once, not once per use
    return f"element_at(transform(array(try_parse_json({body})), doc -> {redacted}), 1)"


def redact_bank(df: DataFrame, columns: tuple[str, ...] = BANK_COLUMNS) -> DataFrame:
    """Flat columns masked wherever they hold a value."""
    masked = {c: F.when(F.col(c).isNotNull(), F.lit(MARKER)) for c in columns if c in df.columns}
    return df.withColumns(masked) if masked else df


def bank_raw_json(columns: list[str], masked: tuple[str, ...] = BANK_COLUMNS) -> str:
    """SQL text: JSON of the whole normalised row with the tax ids masked, NULLs kept."""
    fields = [
        f"'{c}', " + (f"if({c} IS NULL, NULL, '{MARKER}')" if c in masked else c) for c in columns
    ]
    return f"to_json(named_struct({', '.join(fields)}), map('ignoreNullFields', 'false'))"
