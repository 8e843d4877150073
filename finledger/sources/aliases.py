"""Names under which each bank field may arrive, and the wire schemas built from them.

A field arrives under its own name or one of those listed here.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

from finledger.schemas import TABLE_DDL

# Wide enough for any amount as it arrives; tables round to their own scale.
AMOUNT = T.DecimalType(38, 10)

# ---------------------------------------------------------------------------
# The other names of each field, in order of precedence.
# ---------------------------------------------------------------------------
ACCOUNT = {
    "account_cbu": ("cbu",),
    "bank_number": ("bankNumber", "numeroBanco"),
    "account_cuit": ("cuit",),
    "account_label": ("alias", "descripcion", "label"),
    "currency": ("moneda",),
    "bank_name": ("bankName", "nombreBanco"),
    "account_number": ("accountNumber", "numeroCuenta"),
    "account_type": ("accountType", "tipoCuenta"),
}

BALANCE = {
    "bank_number": ("bankNumber", "numeroBanco"),
    "account_number": ("accountNumber", "numeroCuenta"),
    "account_type": ("accountType", "tipoCuenta"),
    "currency": ("moneda",),
    "account_label": ("alias", "label"),
    "account_name": ("accountName", "nombreCuenta"),
    "row_date": ("rowDate", "fecha", "date"),
    "message": ("mensaje",),
    "countable_balance": ("countableBalance", "saldoContable"),
    "initial_operating_balance": ("initialOperatingBalance", "saldoOperativoInicial"),
    "current_operating_balance": ("currentOperatingBalance", "saldoOperativoActual"),
    "projected_balance_24hs": ("projectedBalance24hs", "saldoProyectado24"),
    "projected_balance_48hs": ("projectedBalance48hs", "saldoProyectado48"),
    "operation_date": ("operationDate", "fechaOperacion"),
    "day_balance": ("dayBalance", "saldoDia"),
    "total_debits": ("totalDebits", "totalDebitos"),
    "total_credits": ("totalCredits", "totalCreditos"),
    "is_historical": ("isHistorical", "esHistorico", "historico"),
}

MOVEMENT = {
    "account_cbu": ("cbu",),
    "depositor_code": ("depositorCode", "codigoDepositante"),
    "operation_code_ib": ("operationCodeIb", "codigoOperacionIB"),
    "operation_code_bank": ("operationCodeBank", "codigoOperacionBanco"),
    "code_description_ib": ("codeDescriptionIb", "descripcionIB"),
    "customer_cuit": ("customerCuit", "cuitCliente"),
    "depositor_description": ("depositorDescription", "descripcionDepositante"),
    "code_description_bank": ("codeDescriptionBank", "descripcionBanco"),
    "amount": ("importe",),
    "voucher_number": ("voucherNumber", "nroComprobante"),
    "grouping_code_ib": ("groupingCodeIb", "codigoAgrupamiento"),
    "branch_office_activity": ("branchOfficeActivity", "sucursal"),
    "process_date": ("processDate", "fechaProceso"),
    "debit_credit_type": ("debitCreditType", "tipoMovimiento"),
    "movement_type": ("movementType", "tipMovimiento"),
    "source_account": ("sourceAccount", "cuentaOrigen"),
    "associated_voucher": ("associatedVoucher", "comprobanteAsociado"),
    "real_date_activity": ("realDateActivity", "fechaReal"),
    "movement_date": ("movementDate", "fechaMovimiento"),
    "value_date": ("valueDate", "fechaValor"),
    "correlative_number": ("correlativeNumber", "correlativo"),
}

TRANSFER = {
    "transfer_id": ("transferId", "id"),
    "transaction_number": ("transactionNumber", "nroTransaccion"),
    "request_date": ("requestDate", "fechaSolicitud"),
    "transfer_type_code": ("transferTypeCode", "codigoTipo"),
    "transfer_type_description": ("transferTypeDescription", "descripcionTipo"),
    "account_label": ("alias",),
    "amount": ("importe",),
    "currency": ("moneda",),
    "reference_number": ("referenceNumber", "nroReferencia"),
    "lot_number": ("lotNumber", "nroLote"),
    "payment_number": ("paymentNumber", "nroPago"),
    "status": ("estado",),
    "client": ("cliente",),
    "statement_consolidated": ("statementConsolidated", "resumenConsolidado"),
    "unified_send": ("unifiedSend", "envioUnificado"),
    "direct_import": ("directImport", "importacionDirecta"),
    "same_owner": ("sameOwner", "mismoTitular"),
    "internal_client_id": ("internalClientId", "idClienteInterno"),
    "transfer_comments": ("transferComments", "comentarios"),
}

EXTRACT = {
    "statement_number": ("statementNumber", "nroExtracto"),
    "operation_date": ("operationDate", "fechaOperacion"),
    "total_movements": ("totalMovements", "totalMovimientos"),
    "opening_balance": ("openingBalance", "saldoApertura"),
    "ending_balance": ("endingBalance", "saldoCierre"),
    "operation_code_ib": ("operationCodeIb", "codigoOperacionIB"),
    "operation_code_bank": ("operationCodeBank", "codigoOperacionBanco"),
    "code_description_ib": ("codeDescriptionIb", "descripcionIB"),
    "customer_cuit": ("customerCuit", "cuitCliente"),
    "depositor_description": ("depositorDescription", "descripcionDepositante"),
    "code_description_bank": ("codeDescriptionBank", "descripcionBanco"),
    "movement_date": ("movementDate", "fechaMovimiento"),
    "real_date_activity": ("realDateActivity", "fechaReal"),
    "amount": ("importe",),
    "voucher_number": ("voucherNumber", "nroComprobante"),
    "branch_office_activity": ("branchOfficeActivity", "sucursal"),
    "process_date": ("processDate", "fechaProceso"),
    "value_date": ("valueDate", "fechaValor"),
    "debit_credit_type": ("debitCreditType", "tipoMovimiento"),
    "correlative_number": ("correlativeNumber", "correlativo"),
    "source_account": ("sourceAccount", "cuentaOrigen"),
    "code_description_standard": ("codeDescriptionStandard", "descripcionEstandar"),
    "operation_code_bank_standard": ("operationCodeBankStandard", "codigoBancoEstandar"),
}

VOUCHER = {
    "transfer_id": ("transferId", "id"),
    "request_date": ("requestDate", "fechaSolicitud"),
    "transfer_type_description": ("transferTypeDescription", "descripcionTipo"),
    "transfer_type_code": ("transferTypeCode", "codigoTipo"),
    "network_number": ("networkNumber", "nroRed"),
    "amount": ("importe",),
    "currency": ("moneda",),
    "validation_code": ("validationCode", "codigoValidacion"),
    "total_amount": ("totalAmount", "importeTotal"),
    "comments": ("comentarios",),
}

# Members of a nested credit or debit account.
NESTED_ACCOUNT = {
    "customer_cuit": ("customerCuit", "cuit"),
    "taxpayer_cuit": ("cuitContribuyente",),
    "account_cbu": ("accountCbu", "cbu"),
    "account_number": ("accountNumber", "numeroCuenta"),
    "currency": ("moneda",),
    "account_type": ("accountType", "tipoCuenta"),
    "bank_number": ("bankNumber", "numeroBanco"),
    "bank_name": ("bankName", "nombreBanco"),
    "account_label": ("alias", "label"),
    "voucher_number": (),
}

# Members of the tax block of a voucher.
TAX_BLOCK = {
    "concept_description": ("descripcionConcepto",),
    "control_code": ("codigoControl",),
    "nro_formulario": ("nroFormulario",),
    "tax_description": ("descripcionImpuesto",),
    "fee_number": ("nroCuota",),
    "pago_desc": ("pagDesc",),
    "provider_name": ("nombreProveedor",),
    "concept_code": ("codigoConcepto",),
    "tax_code": ("codigoImpuesto",),
    "vep_number": ("nroVep",),
    "fiscal_period": ("periodoFiscal",),
    "provider_code": ("codigoProveedor",),
}

# Members of the objects that are flattened and kept as JSON text as well.
ADDENDA_FIELDS = (
    "operation_numer", "payment_receipt", "amount", "seller_tax_id", "voucher_type",
    "seller_name", "community_code", "seller_code", "sale_point", "request_date", "issue_date",
    "seller_company_name", "voucher_number", "due_date",
)
BILLING_FIELDS = (
    "billing_company_cuit", "billing_company_name", "billing_account_name", "billing_seller",
    "billing_account_id", "due_date",
)
PAYING_FIELDS = (
    "voucher_number", "debit_bank", "company_name", "linkage_code", "account_cuit",
    "account_cbu", "account_label", "customer_cuit",
)

# Names under which nested objects arrive.
CREDIT_NAMES = ("credit_account", "creditAccount", "cuentaCreditora")
DEBIT_NAMES = ("debit_account", "debitAccount", "cuentaDebitora")
ADDENDA_NAMES = ("addenda",)
BILLING_NAMES = ("billing_company", "billingCompany", "empresaFacturadora")
PAYING_NAMES = ("paying_customer", "payingCustomer", "clientePagador")
TAX_NAMES = ("afip", "datosAfip")

_NAMES = {
    "account": ACCOUNT,
    "balance": BALANCE,
    "movement": MOVEMENT,
    "transfer": TRANSFER,
    "extract": EXTRACT,
    "voucher": VOUCHER,
    "nested_account": NESTED_ACCOUNT,
    "tax_block": TAX_BLOCK,
}

# Fields of a dataset that only ever arrive under their own name.
OWN_NAME_ONLY = {
    "movement": ("grouping_code_standard", "code_description_standard", "operation_code_standard"),
    "extract": ("grouping_code_ib",),
}


def alias_map(dataset: str) -> dict[str, list[str]]:
    """Field name to its other names, in order of precedence."""
    return {name: list(others) for name, others in _NAMES[dataset].items()}


def _amounts() -> set[str]:
    """Names of the columns that are amounts in some table."""
    return {n for ddl in TABLE_DDL.values() for n in re.findall(r"(\w+) DECIMAL", ddl)}


def _field(name: str, column: str) -> T.StructField:
    # JSON numbers read as text pass through a double; as decimals they stay exact
    return T.StructField(name, AMOUNT if column in _amounts() else T.StringType())


def _fields(dataset: str) -> list[T.StructField]:
    names: dict[str, str] = {}
    for column, others in alias_map(dataset).items():
        names.update((n, column) for n in (column, *others))
    names.update((n, n) for n in OWN_NAME_ONLY.get(dataset, ()))
    return [_field(n, column) for n, column in names.items()]


def nested_schema(dataset: str) -> T.StructType:
    return T.StructType(_fields(dataset))


def wire_schema(dataset: str) -> T.StructType:
    """Every name a record of the dataset may use: amounts as decimals, other scalars as
    text, objects that are kept whole as VARIANT."""
    fields = _fields(dataset)
    account, tax = nested_schema("nested_account"), nested_schema("tax_block")
    if dataset in ("transfer", "voucher"):
        fields += [T.StructField(n, account) for n in CREDIT_NAMES + DEBIT_NAMES]
    if dataset == "transfer":
        fields += [T.StructField(n, T.VariantType()) for n in ADDENDA_NAMES]
    if dataset == "voucher":
        fields += [T.StructField(n, T.VariantType()) for n in BILLING_NAMES + PAYING_NAMES]
        fields += [T.StructField(n, tax) for n in TAX_NAMES]
    if dataset == "balance":
        now = [n for n in BALANCE if n != "day_balance" and n.endswith(("_balance", "hs"))]
        fields.append(T.StructField("balances", T.StructType([_field(n, n) for n in now])))
        past = ["operation_date", "day_balance", "total_debits", "total_credits"]
        history = T.StructType([_field(n, n) for n in past])
        fields.append(T.StructField("historical_balances", T.ArrayType(history)))
    if dataset == "extract":
        movement = nested_schema("extract")
        for name in ("movement_detail", "movements_detail"):
            fields.append(T.StructField(name, T.ArrayType(movement)))
    return T.StructType(fields)
