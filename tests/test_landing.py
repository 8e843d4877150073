import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.functions.redact import MARKER
from finledger.operators import flatten
from finledger.operators.normalize import normalize
from finledger.plans import bank
from finledger.sources import aliases, landing
from finledger.sources.conform import conform, require_columns

AT = dt.datetime(2026, 6, 1)


def pages(spark, *bodies, kind=None, account="ACC", page_size=100):
    data = [("IB", "e", "r1", account, "7", kind, i, page_size, AT, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, landing.PAGE_SCHEMA)


@pytest.mark.parametrize("body, expected", [
    ('{"accounts":[{"a":"1"},{"a":"2"}]}', ["1", "2"]),
    ('[{"a":"1"}]', ["1"]),
    ('  [{"a":"1"}]', ["1"]),
    ('{"data":5,"results":[{"a":"1"}]}', ["1"]),
    ('{"accounts":[],"results":[{"a":"1"}]}', []),
    ('{"nothing":[{"a":"1"}]}', []),
    ("{broken", []), ("", []), ("5", []),
])
@pytest.mark.parametrize("typed", [True, False])
def test_extract_records(spark, body, expected, typed):
    record = T.StructType([T.StructField("a", T.StringType())]) if typed else None
    out = landing.extract_records(pages(spark, body), record=record)
    value = F.col("record.a") if typed else F.try_variant_get("record", "$.a", "string")
    assert [r[0] for r in out.orderBy("ordinal").select(value).collect()] == expected


def test_pages_are_stitched_in_order(spark):
    late = pages(spark, '{"data":[{"a":"new"}]}').withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY"))
    both = pages(spark, '{"data":[{"a":"old"}]}', '{"data":[{"a":"x"},{"a":"y"}]}').unionByName(late)
    record = T.StructType([T.StructField("a", T.StringType())])
    out = landing.extract_records(landing.stitch_pages(both), record=record)
    got = out.orderBy("ordinal.page", "ordinal.pos").select("record.a").collect()
    assert [r[0] for r in got] == ["new", "x", "y"]


@pytest.mark.parametrize("bodies, size, complete", [
    (['{"general_data":{"total_rows":3},"data":[{},{}]}', '{"general_data":{"total_rows":3},"data":[{}]}'], 2, True),
    (['{"general_data":{"total_rows":3},"data":[{},{}]}'], 2, False),
    (['{"totalPages":2,"data":[{}]}'], 5, False),
    (['{"last":true,"data":[{}]}'], 1, True),
    (['{"last":false,"data":[{}]}'], 5, False),
    (['{"totalElements":5,"data":[{}]}'], 5, True),
    (['{"data":[{},{}]}'], 2, False),
    (['{"data":[{}]}'], 2, True),
    (['{"data":[]}'], 2, True),
    (['{"general_data":{"total_rows":"many"},"data":[{},{}]}'], 2, False),
])
def test_page_completeness(spark, bodies, size, complete):
    assert landing.page_completeness(pages(spark, *bodies, page_size=size)).first()["complete"] is complete


def test_missing_page_in_the_middle(spark):
    some = pages(spark, "[{},{}]", "[{},{}]", "[{}]", page_size=2).where("page <> 1")
    out = landing.page_completeness(some).first()
    assert (out["missing_pages"], out["complete"], out["records"]) == (1, False, 3)


def test_conform_and_required(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    out = conform(df, T.StructType.fromDDL("b TIMESTAMP_NTZ, a BIGINT"))
    assert out.columns == ["b", "a"] and tuple(out.first()) == (None, 1)
    assert conform(df.limit(0), ["p", "q"]).columns == ["p", "q"]
    with pytest.raises(KeyError, match="table_x"):
        require_columns(df, ["a", "zz"], "table_x")


@pytest.mark.parametrize("record", [
    '{"credit_account":{"account_cbu":"C","bank_number":7}}',
    '{"creditAccount":{"accountCbu":"C","bankNumber":"7"}}',
    '{"cuentaCreditora":{"cbu":"C","numeroBanco":"007"}}',
])
def test_nested_account_names(spark, record):
    rows = bank.wire_rows(pages(spark, f'{{"transfers":[{record}]}}'), "transfer")
    assert not set(aliases.CREDIT_NAMES) & set(rows.columns)
    out = normalize(rows, "transfer").first()
    assert (out["credit_account_account_cbu"], out["credit_account_bank_number"]) == ("C", 7)


def test_addenda_is_flattened_and_kept(spark):
    body = '{"transfers":[{"id":1,"addenda":{"amount":5,"due_date":null,"more":1}},{"id":2,"addenda":"text"}]}'
    out = normalize(bank.wire_rows(pages(spark, body), "transfer"), "transfer").orderBy("transfer_id").collect()
    assert out[0]["addenda"] == '{"amount":5,"due_date":null,"more":1}'
    assert float(out[0]["addenda_amount"]) == 5 and out[0]["addenda_due_date"] is None
    assert out[1]["addenda"] == "text" and out[1]["addenda_amount"] is None


def test_voucher_blocks(spark):
    body = """[{"id":1,"datosAfip":{"nroVep":9,"tax_code":"t"},"billingCompany":{"billing_company_cuit":"1"},
        "clientePagador":{"account_cuit":"2"},"debit_account":{"cuitContribuyente":"3"}}]"""
    out = normalize(bank.wire_rows(pages(spark, body), "voucher"), "voucher").first()
    assert (out["afip_vep_number"], out["afip_tax_code"]) == ("9", "t")
    assert out["billing_company_billing_company_cuit"] == "1"
    assert out["paying_customer_account_cuit"] == "2" and out["debit_account_taxpayer_cuit"] == "3"
    assert out["raw_json"].count(MARKER) == 3


def test_balances_give_a_base_row_and_one_per_day(spark):
    body = """{"data":[{"account_number":"1","balances":{"countable_balance":5},
        "historical_balances":[{"operation_date":"2026-01-01","day_balance":1},{"operation_date":"2026-01-02"}]},
        {"account_number":"2"}]}"""
    out = normalize(bank.wire_rows(pages(spark, body), "balance"), "balance")
    got = [(r["account_number"], r["is_historical"], r["operation_date"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([
        ("1", None, None), ("1", True, dt.datetime(2026, 1, 1)), ("1", True, dt.datetime(2026, 1, 2)),
        ("2", None, None)], key=repr)


def test_statements(spark):
    body = """{"statements":[
        {"statement_number":1,"operation_date":"2026-01-01","movement_detail":[{"importe":5,"operation_date":"2026-01-09"},{"amount":6}]},
        {"statement_number":2,"movement_detail":[],"movements_detail":[{"amount":7}]},
        {"statement_number":3}]}"""
    out = normalize(bank.wire_rows(pages(spark, body), "extract"), "extract")
    got = sorted((r["statement_number"], r["amount"] and float(r["amount"]), r["operation_date"], r["source_account"]) for r in out.collect() if r["amount"])
    assert got == [("1", 5.0, dt.datetime(2026, 1, 9), "ACC"), ("1", 6.0, dt.datetime(2026, 1, 1), "ACC"),
                   ("2", 7.0, None, "ACC")]
    assert out.where("statement_number = '3' AND amount IS NULL").count() == 1


def movement(spark, record, kind="anteriores", account="ACC", **extra):
    rows = bank.wire_rows(pages(spark, f"[{record}]", kind=kind, account=account), "movement")
    if kind == "dia":
        now = F.lit(AT).cast("timestamp_ntz")
        return normalize(rows, "movement", "dia", now, ["ordinal"], bank.arrival_block())
    return normalize(rows, "movement", kind)


def test_settled_movement(spark):
    out = movement(spark, '{"amount":5,"process_date":"2026-05-30","source_account":"other","customer_cuit":"20"}').first()
    assert (out["source_account"], out["movement_type"], out["movement_source"]) == ("ACC", "anteriores", "anteriores")
    assert len(out["movement_hash"]) == 64 and out["process_date"] == dt.datetime(2026, 5, 30)
    assert out["customer_cuit"] == "20" and MARKER in out["raw_json"] and out["movement_hash"] in out["raw_json"]


@pytest.mark.parametrize("record, expected", [
    ('{"amount":5,"process_date":"2026-05-30T10:11:12"}', dt.datetime(2026, 5, 30, 10, 11, 12)),
    ('{"amount":5}', AT),
    ('{"amount":5,"movement_date":"2026-05-29"}', dt.datetime(2026, 5, 29)),
])
def test_same_day_movement_gets_a_date(spark, record, expected):
    assert movement(spark, record, "dia").first()["movement_date"] == expected


def test_movement_keys(spark):
    def hashes(record, kind="anteriores", account="ACC"):
        return sorted(r["movement_hash"] for r in movement(spark, record, kind, account).collect())

    a = '{"amount":5,"process_date":"2026-05-30"}'
    assert hashes(a) == hashes('{"importe":"5.00","fechaProceso":"2026-05-30T00:00:00"}')
    assert hashes(a) != hashes(a, "dia") and hashes(a) != hashes(a, account="B")
    twins = hashes(f"{a},{a}", "dia")
    assert len(set(twins)) == 2 and set(hashes(a, "dia")) < set(twins)
    assert hashes(f"{a},{a},{a}", "dia") == sorted(set(hashes(f"{a},{a},{a}", "dia")))
    assert hashes('{"amount":6,"process_date":"2026-05-30"}', "dia") != hashes(a, "dia")


def test_flatten_prefix(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2, 'y', 3) AS n")
    out = flatten.flatten_prefix(df, "n", "p")
    assert out.columns == ["a", "p_x", "p_y"] and tuple(out.first()) == (1, 2, 3)


def test_payment_document(spark):
    body = """{"id":"9","collector_id":0,"collector":{"id":4},"payer_id":3,"payer":{"id":8},
        "transaction_amount":10.555,"date_created":"2026-01-01T10:00:00.000-03:00","order":{"id":77},
        "charges_details":[{"id":"c","amounts":{"original":1},"metadata":{"tax_id":5}},{"id":null}],
        "additional_info":{"items":[{"id":" 5 ","quantity":"1.5"}]}}"""
    df = spark.createDataFrame([(body,), ('{"id":10}',), ('{"id":11,"charges_details":null,"payer":"x"}',)], "body string")
    parent = {r["payment_id"]: r for r in flatten.payment_parent(df).collect()}
    assert set(parent) == {9, 10, 11}
    p = parent[9]
    assert (p["collector_id"], p["payer_id"], p["order_id"]) == (4, 3, "77")
    assert p["date_created"] == dt.datetime(2026, 1, 1, 10)
    assert [(r["payment_id"], r["charge_id"], r["tax_id"]) for r in flatten.payment_charges(df).collect()] == [(9, "c", 5), (9, None, None)]
    assert [(r["item_id"], float(r["quantity"])) for r in flatten.payment_items(df).collect()] == [("5", 1.5)]


def test_amounts_stay_exact(spark):
    body = """{"transfers":[{"id":1,"importe":1234567890123456.78,
        "addenda":{"amount":1234567890123456.78,"operation_numer":12345678}}]}"""
    out = normalize(bank.wire_rows(pages(spark, body), "transfer"), "transfer").first()
    assert str(out["amount"]) == str(out["addenda_amount"]) == "1234567890123456.78"
    assert out["addenda_operation_numer"] == "12345678"
    big = movement(spark, '{"amount":"1234567890123456.78","voucher_number":123456789.0}').first()
    assert (str(big["amount"]), big["voucher_number"]) == ("1234567890123456.78", "123456789")
