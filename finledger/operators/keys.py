"""Natural-key hashes over canonical text.

Amounts hash as two-decimal text, instants in one spelling, identifiers trimmed, so a
key does not depend on how a batch happened to be typed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.functions.scalars import (
    canonical_amount,
    canonical_int,
    canonical_ts,
    cast,
    parts_text,
    sha256_of_parts,
    to_bool,
    to_str,
)
from finledger.operators.ranking import index_in_group


def balance_key() -> str:
    """SQL text of the key, like the others below."""
    return sha256_of_parts(
        canonical_int("bank_number"), to_str("account_number"), "account_type", "currency",
        canonical_ts("row_date"), canonical_ts("operation_date"),
        cast(to_bool("is_historical"), "string"), canonical_amount("day_balance"),
    )


def movement_key() -> str:
    """Key of a settled movement."""
    return sha256_of_parts(
        to_str("source_account"), to_str("voucher_number"), canonical_ts("process_date"),
        canonical_amount("amount"), "debit_credit_type", "operation_code_ib",
        to_str("branch_office_activity"), to_str("correlative_number"),
    )


def extract_key() -> str:
    return sha256_of_parts(
        to_str("statement_number"), to_str("source_account"), to_str("voucher_number"),
        canonical_ts("process_date"), canonical_amount("amount"), "debit_credit_type",
        to_str("correlative_number"),
    )


def provisional_text() -> str:
    """What makes two same-day movements identical, the arrival index aside."""
    return parts_text(
        "'dia'", to_str("source_account"), canonical_ts("process_date"),
        canonical_amount("amount"), "debit_credit_type", "operation_code_ib",
        to_str("branch_office_activity"), to_str("voucher_number"), to_str("correlative_number"),
    )


def provisional_key(df: DataFrame, order: Sequence[str | Column], block: Column) -> DataFrame:
    """Key of a same-day movement, which the bank does not number yet.

    Identical movements get an index 0, 1, 2… in arrival order; a feed that only grows
    keeps the index of the movements already seen, hence their keys. ``block`` cuts the
    arrival order into bounded stretches (see ``index_in_group``).
    """
    grouped = df.withColumn("__text", F.expr(provisional_text()))
    ranked = index_in_group(grouped, ["__text"], order, block, "seq")
    text = F.concat_ws("|", F.col("__text"), F.col("seq").cast("string"))
    return ranked.withColumn("movement_hash", F.sha2(text, 256)).drop("__text")
