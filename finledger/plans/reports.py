"""Operational reports over the ledger tables. Time always comes in as a parameter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.functions.scalars import diff_boundaries, null_label
from finledger.operators import filters
from finledger.operators.dedup import keep_first, keep_last


def _ts(value) -> F.Column:
    return F.lit(value).cast("timestamp_ntz")


def newest(df: DataFrame, by: str, tiebreak: str, n: int) -> DataFrame:
    """The ``n`` latest rows; ties are settled by the second column."""
    return df.orderBy(F.desc(by), F.desc(tiebreak)).limit(n)


def latest_runs(runs: DataFrame, n: int = 10, source: str | None = None) -> DataFrame:
    runs = runs.where(F.col("source_system") == source) if source else runs
    return newest(runs, "started_at", "sync_run_id", n)


def recent_errors(runs: DataFrame, n: int = 20) -> DataFrame:
    columns = ["sync_run_id", "process_name", "started_at", "finished_at", "status", "error_message"]
    return newest(runs.where(F.col("status") == "ERROR").select(*columns), "started_at", "sync_run_id", n)


def latest_payments(payments: DataFrame, n: int = 10) -> DataFrame:
    return newest(payments, "date_last_updated", "payment_id", n)


def latest_movements(movements: DataFrame, n: int = 10) -> DataFrame:
    return newest(movements, "process_date", "movement_id", n)


def control_status(control: DataFrame, process_prefix: str = "") -> DataFrame:
    """Status columns of the processes whose name starts with the prefix, by name."""
    return (
        control.where(F.col("process_name").startswith(process_prefix))
        .select("process_name", "last_status", "last_successful_sync", "last_error")
        .orderBy("process_name")
    )


def minutes_since_success(control: DataFrame, as_of) -> DataFrame:
    return control.select(
        "process_name", "last_status", "last_successful_sync",
        diff_boundaries("MINUTE", F.col("last_successful_sync"), _ts(as_of)).alias(
            "minutes_since_last_success"
        ),
    ).orderBy(F.desc("last_successful_sync"), "process_name")


def last_success(control: DataFrame, process_prefix: str) -> DataFrame:
    return control.where(F.col("process_name").startswith(process_prefix)).agg(
        F.max("last_successful_sync").alias("last_successful_sync")
    )


def payments_per_day(payments: DataFrame, as_of, days: int = 30) -> DataFrame:
    return (
        payments.where(filters.within("date_last_updated", as_of, f"{days} DAYS"))
        .groupBy(F.to_date("date_last_updated").alias("day"))
        .agg(F.count(F.lit(1)).alias("payments"))
        .orderBy(F.desc("day"))
    )


def run_durations(runs: DataFrame, source: str | None = None) -> DataFrame:
    runs = runs.where(F.col("source_system") == source) if source else runs
    return runs.select(
        "process_name", "started_at", "finished_at", "status",
        diff_boundaries("SECOND", F.col("started_at"), F.col("finished_at")).alias("duration_sec"),
    ).orderBy(F.desc("started_at"))


def last_run_per_process(runs: DataFrame) -> DataFrame:
    return keep_last(
        runs.select("process_name", "started_at", "sync_run_id", "status", "rows_upserted",
                    "error_message"),
        ["process_name"], ["started_at", "sync_run_id"],
    )


# -- payments ---------------------------------------------------------------
def payments_by_status(payments: DataFrame, status: str, begin, end) -> DataFrame:
    return payments.where(
        (F.col("status") == status) & F.col("date_created").between(_ts(begin), _ts(end))
    ).select("payment_id", "status", "date_created", "transaction_amount", "payer_id",
             "external_reference")


def payments_by_payer(payments: DataFrame, payer_id: int) -> DataFrame:
    return payments.where(F.col("payer_id") == payer_id).select(
        "payment_id", "payer_id", "status", "transaction_amount", "date_created"
    )


def payments_by_reference(payments: DataFrame, reference: str) -> DataFrame:
    return payments.where(F.col("external_reference") == reference)


def payments_by_store(payments: DataFrame, store_id: str, pos_id: str | None = None) -> DataFrame:
    out = payments.where(F.col("store_id") == store_id)
    return out.where(F.col("pos_id") == pos_id) if pos_id is not None else out


def _days(col: str, begin, end) -> Column:
    """A closed range; an end given as a date includes that whole day."""
    return (F.col(col) >= _ts(begin)) & filters.up_to(col, end)


# -- bank -------------------------------------------------------------------
def movements_by_account(movements: DataFrame, account: str, begin, end,
                         account_col: str = "source_account") -> DataFrame:
    return movements.where(
        (F.col(account_col) == account) & _days("process_date", begin, end)
    )


def movements_by_date(movements: DataFrame, begin, end) -> DataFrame:
    return movements.where(_days("process_date", begin, end))


def transfer_list(transfers: DataFrame, begin, end, n: int | None = None) -> DataFrame:
    """Transfers of a closed range in order of request, or the first ``n`` of them."""
    rows = transfers.where(_days("request_date", begin, end)).select(
        "transfer_id", "request_date", "amount", "currency", "status"
    )
    return rows if n is None else head_in_order(rows, ["request_date", "transfer_id"], n)


def extracts_by_account(extracts: DataFrame, account: str, begin, end) -> DataFrame:
    return extracts.where(
        (F.col("source_account") == account) & _days("operation_date", begin, end)
    )


def balances_by_account(balances: DataFrame, account: str, begin, end) -> DataFrame:
    return balances.where(
        (F.col("account_number") == account) & _days("row_date", begin, end)
    )


def provenance_split(movements: DataFrame) -> DataFrame:
    """Movements per source, rows without one under a label of their own."""
    return movements.groupBy(null_label(F.col("movement_source")).alias("movement_source")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def account_list(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_number", "bank_name", "currency", "account_type")


def current_balances(balances: DataFrame) -> DataFrame:
    return balances.where(filters.current_only()).select(
        "account_number", "account_label", "bank_number", "countable_balance",
        "initial_operating_balance", "current_operating_balance", "projected_balance_24hs",
        "projected_balance_48hs",
    )


def historical_balances(balances: DataFrame) -> DataFrame:
    return balances.where(filters.historical_only()).select(
        "account_number", "operation_date", "day_balance", "total_debits", "total_credits"
    )


def head_in_order(df: DataFrame, ordinal: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in arrival order."""
    return df.orderBy(*ordinal).limit(n)


def statement_summary(extracts: DataFrame, ordinal: list[str]) -> DataFrame:
    """One header row per statement, taken from its first row."""
    return keep_first(
        extracts.select("statement_number", "operation_date", "total_movements",
                        "opening_balance", "ending_balance", *ordinal),
        ["statement_number"], ordinal,
    ).drop(*ordinal)


def statement_detail(
    extracts: DataFrame, statement: str, ordinal: list[str], n: int | None = None
) -> DataFrame:
    """The detail rows of one statement, or the first ``n`` of them; a header without movement is
    no detail."""
    mine = extracts.where((F.col("statement_number") == statement) & F.col("amount").isNotNull())
    return (mine if n is None else head_in_order(mine, ordinal, n)).select(
        "statement_number", "real_date_activity", "amount", "debit_credit_type",
        "code_description_bank",
    )


def availability_matrix(accounts: DataFrame, datasets: Mapping[str, tuple[DataFrame, str, str | None]],
                        as_of: dt.date, days: int = 90) -> DataFrame:
    """Rows of the last days per account and dataset; 0 means not available.

    ``datasets`` maps a name to (rows, account column, date column or None for all time).
    Each dataset is counted per account first, so only counts meet the accounts.
    """
    begin = as_of - dt.timedelta(days=days)
    out = accounts.select("account_number", "bank_name", "currency")
    for name, (df, account_col, date_col) in datasets.items():
        if date_col:
            df = df.where((F.col(date_col) >= F.lit(begin)) & filters.up_to(date_col, as_of))
        counts = df.groupBy(F.col(account_col).alias("account_number")).agg(
            F.count(F.lit(1)).alias(f"__{name}")
        )
        out = out.join(counts, "account_number", "left").withColumn(
            name, F.coalesce(F.col(f"__{name}"), F.lit(0))
        ).drop(f"__{name}")
    return out
