"""Table schemas, keys and update rules as data.

Timestamps are zone-free (TIMESTAMP_NTZ), amounts are exact decimals and JSON
text stays STRING at rest.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, order and types of the ledger tables.
# ---------------------------------------------------------------------------
TABLE_DDL: dict[str, str] = {
    "sync_runs": """
        sync_run_id BIGINT, source_system STRING, process_name STRING,
        started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, status STRING,
        rows_read INT, rows_upserted INT, rows_deleted_reloaded INT, error_message STRING
    """,
    "sync_control": """
        process_name STRING, source_system STRING, last_successful_sync TIMESTAMP_NTZ,
        last_attempt_sync TIMESTAMP_NTZ, last_begin_date_used TIMESTAMP_NTZ,
        last_end_date_used TIMESTAMP_NTZ, last_status STRING, last_error STRING,
        updated_at TIMESTAMP_NTZ
    """,
    "audit_totals": """
        table_name STRING, rule STRING, columns STRING, violations BIGINT, audited BIGINT,
        counted BIGINT
    """,
    "audit_values": "rule STRING, value STRING, n BIGINT",
    "mp_payment_items": """
        item_row_id BIGINT, payment_id BIGINT, item_id STRING, category_id STRING,
        title STRING, description STRING, quantity DECIMAL(18,4), unit_price DECIMAL(18,2),
        picture_url STRING, created_at TIMESTAMP_NTZ
    """,
    "mp_payment_charges": """
        charge_row_id BIGINT, payment_id BIGINT, charge_id STRING, charge_type STRING,
        charge_name STRING, account_from STRING, account_to STRING,
        amount_original DECIMAL(18,2), amount_refunded DECIMAL(18,2),
        base_amount DECIMAL(18,2), rate DECIMAL(18,6), reserve_id BIGINT, client_id BIGINT,
        tax_id BIGINT, tax_status STRING, mov_detail STRING, mov_financial_entity STRING,
        mov_type STRING, metadata_user_id BIGINT, metadata_source STRING,
        charge_date_created TIMESTAMP_NTZ, charge_last_updated TIMESTAMP_NTZ,
        created_at TIMESTAMP_NTZ
    """,
    "mp_payments": """
        payment_id BIGINT, collector_id BIGINT, payer_id BIGINT, external_reference STRING,
        order_id STRING, order_type STRING, status STRING, status_detail STRING,
        operation_type STRING, payment_method_id STRING, payment_type_id STRING,
        payment_method_type STRING, issuer_id STRING, currency_id STRING, installments INT,
        transaction_amount DECIMAL(18,2), transaction_amount_refunded DECIMAL(18,2),
        shipping_amount DECIMAL(18,2), shipping_cost DECIMAL(18,2), taxes_amount DECIMAL(18,2),
        coupon_amount DECIMAL(18,2), net_received_amount DECIMAL(18,2),
        total_paid_amount DECIMAL(18,2), installment_amount DECIMAL(18,2),
        overpaid_amount DECIMAL(18,2), description STRING, authorization_code STRING,
        money_release_status STRING, binary_mode BOOLEAN, captured BOOLEAN, live_mode BOOLEAN,
        store_id STRING, pos_id STRING, notification_url STRING, statement_descriptor STRING,
        processing_mode STRING, point_type STRING, point_unit STRING, point_sub_unit STRING,
        point_branch STRING, point_source STRING, point_state_id STRING, payer_email STRING,
        payer_identification_type STRING, payer_identification_number STRING,
        card_first_six_digits STRING, card_last_four_digits STRING, cardholder_name STRING,
        cardholder_ident_type STRING, cardholder_ident_number STRING,
        date_created TIMESTAMP_NTZ, date_approved TIMESTAMP_NTZ,
        date_last_updated TIMESTAMP_NTZ, money_release_date TIMESTAMP_NTZ, raw_json STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
    """,
    "ib_accounts": """
        account_cbu STRING, bank_number INT, account_cuit STRING, account_label STRING,
        currency STRING, bank_name STRING, account_number STRING, account_type STRING,
        raw_json STRING, imported_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
    """,
    "ib_balances": """
        balance_id BIGINT, balance_hash STRING, bank_number INT, account_number STRING,
        account_type STRING, currency STRING, account_label STRING, account_name STRING,
        row_date TIMESTAMP_NTZ, message STRING, countable_balance DECIMAL(18,2),
        initial_operating_balance DECIMAL(18,2), current_operating_balance DECIMAL(18,2),
        projected_balance_24hs DECIMAL(18,2), projected_balance_48hs DECIMAL(18,2),
        operation_date TIMESTAMP_NTZ, day_balance DECIMAL(18,2), total_debits DECIMAL(18,2),
        total_credits DECIMAL(18,2), is_historical BOOLEAN, raw_json STRING,
        imported_at TIMESTAMP_NTZ
    """,
    "ib_movements": """
        movement_id BIGINT, movement_hash STRING, account_cbu STRING, depositor_code STRING,
        operation_code_ib STRING, operation_code_bank STRING, code_description_ib STRING,
        customer_cuit STRING, depositor_description STRING, code_description_bank STRING,
        amount DECIMAL(18,2), voucher_number STRING, grouping_code_ib STRING,
        branch_office_activity STRING, process_date TIMESTAMP_NTZ, debit_credit_type STRING,
        movement_type STRING, source_account STRING, associated_voucher STRING,
        real_date_activity TIMESTAMP_NTZ, movement_date TIMESTAMP_NTZ, value_date TIMESTAMP_NTZ,
        correlative_number STRING, grouping_code_standard STRING,
        code_description_standard STRING, operation_code_standard STRING,
        movement_source STRING, raw_json STRING, imported_at TIMESTAMP_NTZ
    """,
    "ib_transfers": """
        transfer_id BIGINT, transaction_number STRING, request_date TIMESTAMP_NTZ,
        transfer_type_code STRING, transfer_type_description STRING, account_label STRING,
        amount DECIMAL(18,2), currency STRING, reference_number STRING, lot_number STRING,
        payment_number STRING, status STRING, client STRING, statement_consolidated STRING,
        unified_send STRING, direct_import STRING, same_owner STRING, internal_client_id STRING,
        addenda STRING, transfer_comments STRING, credit_account_customer_cuit STRING,
        credit_account_account_cbu STRING, credit_account_account_number STRING,
        credit_account_currency STRING, credit_account_account_type STRING,
        credit_account_bank_number INT, credit_account_bank_name STRING,
        credit_account_account_label STRING, debit_account_customer_cuit STRING,
        debit_account_account_cbu STRING, debit_account_account_number STRING,
        debit_account_currency STRING, debit_account_account_type STRING,
        debit_account_bank_number INT, debit_account_bank_name STRING,
        debit_account_account_label STRING, addenda_operation_numer STRING,
        addenda_payment_receipt STRING, addenda_amount DECIMAL(18,2),
        addenda_seller_tax_id STRING, addenda_voucher_type STRING, addenda_seller_name STRING,
        addenda_community_code STRING, addenda_seller_code STRING, addenda_sale_point STRING,
        addenda_request_date TIMESTAMP_NTZ, addenda_issue_date TIMESTAMP_NTZ,
        addenda_seller_company_name STRING, addenda_voucher_number STRING,
        addenda_due_date TIMESTAMP_NTZ, raw_json STRING, imported_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ
    """,
    "ib_vouchers": """
        voucher_id BIGINT, transfer_id BIGINT, request_date TIMESTAMP_NTZ,
        transfer_type_description STRING, transfer_type_code STRING, network_number STRING,
        amount DECIMAL(18,2), currency STRING, validation_code STRING,
        total_amount DECIMAL(18,2), comments STRING, billing_company STRING,
        paying_customer STRING, debit_account_customer_cuit STRING,
        debit_account_account_cbu STRING, debit_account_taxpayer_cuit STRING,
        debit_account_bank_number INT, debit_account_bank_name STRING,
        debit_account_account_label STRING, afip_concept_description STRING,
        afip_control_code STRING, afip_nro_formulario STRING, afip_tax_description STRING,
        afip_fee_number STRING, afip_pago_desc STRING, afip_provider_name STRING,
        afip_concept_code STRING, afip_tax_code STRING, afip_vep_number STRING,
        afip_fiscal_period STRING, afip_provider_code STRING,
        credit_account_customer_cuit STRING, credit_account_account_cbu STRING,
        credit_account_bank_number INT, credit_account_bank_name STRING,
        credit_account_account_label STRING, debit_account_voucher_number STRING,
        billing_company_billing_company_cuit STRING, billing_company_billing_company_name STRING,
        billing_company_billing_account_name STRING, billing_company_billing_seller STRING,
        billing_company_billing_account_id STRING, billing_company_due_date TIMESTAMP_NTZ,
        paying_customer_voucher_number STRING, paying_customer_debit_bank STRING,
        paying_customer_company_name STRING, paying_customer_linkage_code STRING,
        paying_customer_account_cuit STRING, paying_customer_account_cbu STRING,
        paying_customer_account_label STRING, paying_customer_customer_cuit STRING,
        raw_json STRING, imported_at TIMESTAMP_NTZ
    """,
    "ib_extracts": """
        extract_id BIGINT, extract_hash STRING, statement_number STRING,
        operation_date TIMESTAMP_NTZ, total_movements INT, opening_balance DECIMAL(18,2),
        ending_balance DECIMAL(18,2), operation_code_ib STRING, operation_code_bank STRING,
        code_description_ib STRING, customer_cuit STRING, depositor_description STRING,
        code_description_bank STRING, movement_date TIMESTAMP_NTZ,
        real_date_activity TIMESTAMP_NTZ, amount DECIMAL(18,2), voucher_number STRING,
        grouping_code_ib STRING, branch_office_activity STRING, process_date TIMESTAMP_NTZ,
        value_date TIMESTAMP_NTZ, debit_credit_type STRING, correlative_number STRING,
        source_account STRING, code_description_standard STRING,
        operation_code_bank_standard STRING, raw_json STRING, imported_at TIMESTAMP_NTZ
    """,
}


@dataclass(frozen=True)
class TableSpec:
    """How one ledger table is keyed, versioned and laid out on disk."""

    name: str
    keys: tuple[str, ...]
    surrogate: str | None = None
    created: str = "imported_at"
    touch: str | None = None  # column refreshed on update, None = leave rows' age alone
    parent: tuple[str, str, str] | None = None  # (child column, parent table, parent column)
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()  # further unique keys, checked where not null
    partition_by: str | None = None  # low-cardinality column kept as the outer folder
    buckets: int = 16  # see scaled_specs

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(TABLE_DDL[self.name])

    @property
    def update_cols(self) -> list[str]:
        """Every payload column: not a key, not the surrogate, not bookkeeping."""
        fixed = {*self.keys, self.surrogate, self.created, "updated_at"}
        return [c for c in self.schema.names if c not in fixed]


SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec("mp_payments", ("payment_id",), created="created_at", touch="updated_at",
                  not_null=("payment_id",)),
        TableSpec("mp_payment_charges", ("payment_id", "charge_id"), "charge_row_id", "created_at",
                  parent=("payment_id", "mp_payments", "payment_id"),
                  not_null=("payment_id", "charge_id")),
        TableSpec("mp_payment_items", (), "item_row_id", "created_at",
                  parent=("payment_id", "mp_payments", "payment_id"), not_null=("payment_id",)),
        TableSpec("ib_accounts", ("account_cbu",), touch="updated_at", not_null=("account_cbu",)),
        TableSpec("ib_balances", ("balance_hash",), "balance_id", not_null=("balance_hash",)),
        TableSpec("ib_movements", ("movement_hash",), "movement_id",
                  not_null=("movement_hash",), partition_by="movement_source"),
        TableSpec("ib_transfers", ("transfer_id",), touch="updated_at", not_null=("transfer_id",),
                  unique=(("transaction_number",),)),
        TableSpec("ib_vouchers", ("transfer_id",), "voucher_id",
                  parent=("transfer_id", "ib_transfers", "transfer_id"),
                  not_null=("transfer_id",)),
        TableSpec("ib_extracts", ("extract_hash",), "extract_id", not_null=("extract_hash",)),
    )
}

# What an audit kept by commits stores beside the tables: violations per rule, and how many rows hold each
# value of a unique key that the table is not divided by.
AUDIT_TOTALS = TableSpec("audit_totals", ("table_name", "rule", "columns"), buckets=1)
AUDIT_VALUES = TableSpec("audit_values", ("rule", "value"))


def scaled_specs(buckets: int, specs: dict[str, TableSpec] = SPECS) -> dict[str, TableSpec]:
    """The same tables with another number of buckets: about one gigabyte per bucket is
    right, so a table of 10 TB wants some 10,000. Fixed for the life of a table."""
    return {name: replace(spec, buckets=buckets) for name, spec in specs.items()}


# Children before parents: the order in which tables may be emptied.
RESET_ORDER = (
    "mp_payment_charges", "mp_payment_items", "ib_vouchers", "mp_payments", "ib_transfers",
    "ib_extracts", "ib_movements", "ib_balances", "ib_accounts", "sync_runs",
)

# One control row per process: (process name, source system).
CONTROL_SEED = (
    ("mp_payments", "MP"),
    ("ib_accounts", "IB"),
    ("ib_balances", "IB"),
    ("ib_movements", "IB"),
    ("ib_transfers", "IB"),
    ("ib_vouchers", "IB"),
    ("ib_extracts", "IB"),
)


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[name])
