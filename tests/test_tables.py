import datetime as dt
import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from finledger.operators import audit
from finledger.plans import bank, payments
from finledger.schemas import CONTROL_SEED, SPECS, scaled_specs, table_schema
from finledger.sources.audits import update_audit
from finledger.sources.landing import PAGE_SCHEMA
from finledger.sources.commits import Conflict, commit, read_log, snapshot, transact
from finledger.sources.conform import conform
from finledger.sources.tables import (
    BUCKET,
    bucket_of,
    compact_table,
    export_tables,
    prepare,
    prepare_upsert,
    read_table,
    reset_table,
    touched,
    upsert_table,
    vacuum_table,
    write_table,
)

AT = dt.datetime(2026, 6, 1)


def doc(i, version="2026-05-27T07:00:00.000-04:00", charges=2, **extra):
    return json.dumps({
        "id": i, "status": "approved", "transaction_amount": 10.5, "date_last_updated": version,
        "date_created": "2026-05-01T00:00:00", "payer": {"email": "a@b"},
        "charges_details": [{"id": f"c{k}"} for k in range(charges)],
        "additional_info": {"items": [{"id": k} for k in range(charges)]}, **extra,
    })


def landed(spark, *docs):
    return spark.createDataFrame([(d, n) for n, d in enumerate(docs)], "body string, seq int")


def table(spark, root, name, stored=False):
    return read_table(spark, f"{root}/{name}", SPECS[name], stored)


def test_payment_batches(spark, now, tmp_path):
    root = str(tmp_path)

    def apply(batch, *docs):
        return payments.apply_payments(spark, root, landed(spark, *docs), ["seq"], now, batch)

    first = apply("b1", doc(1), doc(2), doc(2, status="refunded"), doc(3))
    assert first == {"processed": 3, "skipped": 0, "charges": 6, "items": 6, "errors": 0}
    assert table(spark, root, "mp_payments").where("payment_id = 2").first()["status"] == "refunded"
    again = apply("b2", doc(1), doc(2), doc(3), "{broken", json.dumps({"id": "12.0x"}))
    assert again == {"processed": 3, "skipped": 3, "charges": 0, "items": 0, "errors": 2}
    dead = spark.read.parquet(f"{root}/dead_letters").collect()
    assert sorted(r["error"] for r in dead) == ["invalid_json", "missing_id"]
    before = {r["payment_id"]: r["charge_row_id"] for r in table(spark, root, "mp_payment_charges").where("payment_id <> 1").collect()}
    third = apply("b3", doc(1, "2026-05-20T00:00:00", charges=0), doc(2))
    assert third == {"processed": 2, "skipped": 1, "charges": 0, "items": 0, "errors": 0}
    charges = table(spark, root, "mp_payment_charges")
    assert {r[0] for r in charges.select("payment_id").collect()} == {2, 3}
    assert {r["payment_id"]: r["charge_row_id"] for r in charges.collect()} == before
    assert charges.select("charge_row_id").distinct().count() == 4
    p = table(spark, root, "mp_payments").where("payment_id = 1").first()
    assert p["date_last_updated"] == dt.datetime(2026, 5, 20) and "a@b" not in p["raw_json"]
    tables = {n: table(spark, root, n) for n in ("mp_payments", "mp_payment_charges", "mp_payment_items")}
    assert audit.audit_constraints(tables).agg(F.sum("violations")).first()[0] == 0


def test_a_batch_that_dies_between_its_tables_is_not_seen(spark, now, tmp_path, monkeypatch):
    root, names = str(tmp_path), ("mp_payments", "mp_payment_charges", "mp_payment_items")
    payments.apply_payments(spark, root, landed(spark, doc(1), doc(2)), ["seq"], now, "b1")
    before = {n: rows(table(spark, root, n)) for n in names}

    def dies(*args, **kwargs):
        raise RuntimeError("driver lost")

    batch = landed(spark, doc(1, "2026-06-01", 3))
    with monkeypatch.context() as m:
        m.setattr(payments, "prepare_upsert", dies)
        with pytest.raises(RuntimeError):
            payments.apply_payments(spark, root, batch, ["seq"], now, "b2")
    assert {n: rows(table(spark, root, n)) for n in names} == before
    at = snapshot(spark, root)
    payments.apply_payments(spark, root, batch, ["seq"], now, "b2")
    assert table(spark, root, "mp_payment_charges").count() == 5
    assert {n: rows(read_table(spark, f"{root}/{n}", SPECS[n], at=at)) for n in names} == before
    assert snapshot(spark, root) == at + 1
    log = [c for c in read_log(spark, root) if c.seq == at + 1]
    assert sorted(c.table_name for c in log) == sorted(names) and {c.batch_id for c in log} == {"b2"}


def balances(spark, keys, message):
    spec = SPECS["ib_balances"]
    df = spark.createDataFrame([(str(k), message) for k in keys], "balance_hash string, message string")
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(spec.schema[c].dataType).alias(c)
        for c in (*spec.keys, *spec.update_cols)
    ])


def test_interleaved_writers(spark, now, tmp_path):
    """A writer whose commit comes second starts over from the first one's state."""
    root, spec = str(tmp_path), SPECS["ib_balances"]
    path, tries = f"{root}/ib_balances", []
    mine = balances(spark, range(6), "mine").withColumn(BUCKET, bucket_of(spec))

    def build(at):
        tries.append(at)
        change = prepare_upsert(spark, path, spec, mine, now, "mine", at, touched(mine, spec))
        if len(tries) == 1:
            upsert_table(spark, path, spec, balances(spark, range(4, 9), "theirs"), now, "theirs")
        return [change], change.rows

    assert transact(spark, root, "mine", build) == 6 and tries == [0, 1]
    got = read_table(spark, path, spec).collect()
    assert {r["balance_hash"]: r["message"] for r in got} == {
        str(k): "mine" if k < 6 else "theirs" for k in range(9)
    }
    assert sorted(r["balance_id"] for r in got) == list(range(1, 10))
    folders = [p.name for p in (tmp_path / "ib_balances" / "rows").iterdir()]
    assert len(folders) == 2  # what the first try wrote is gone


def test_writers_of_other_keys_and_tables_do_not_wait(spark, now, tmp_path):
    root, spec = str(tmp_path), SPECS["ib_accounts"]
    path = f"{root}/ib_accounts"

    def accounts(*keys):
        return spark.createDataFrame([(k, "x") for k in keys], "account_cbu string, account_label string")

    def change(key, at, **more):
        df = conform(accounts(key), spec.schema).withColumn("row_gone", F.lit(False))
        return prepare(spark, path, spec, df, key, at, **more)

    first, second, same = change("1", 0), change("2", 0), change("1", 0)
    assert commit(spark, root, "a", [first], 0) == 1
    assert commit(spark, root, "b", [second], 0) == 2
    with pytest.raises(Conflict):
        commit(spark, root, "c", [same], 0)
    assert sorted(r[0] for r in read_table(spark, path, spec).select("account_cbu").collect()) == ["1", "2"]
    assert commit(spark, root, "c", [same], 2) == 3


def test_threads_write_at_once(spark, now, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    spec, path = SPECS["ib_balances"], f"{tmp_path}/ib_balances"
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(
            lambda k: upsert_table(spark, path, spec, balances(spark, range(k, k + 4), "x"), now, f"b{k}"),
            range(0, 9, 3),
        ))
    got = read_table(spark, path, spec).collect()
    assert sorted(int(r["balance_hash"]) for r in got) == list(range(10))
    ids = [r["balance_id"] for r in got]
    assert len(set(ids)) == 10
    assert [c.seq for c in read_log(spark, str(tmp_path))] == [1, 2, 3]


def test_lookups_open_only_folders_that_may_hold_the_key(spark, now, tmp_path):
    spec, path = SPECS["ib_accounts"], f"{tmp_path}/ib_accounts"
    for k in range(12):
        write_table(spark.createDataFrame([(str(k), f"n{k}")], "account_cbu string, account_label string"),
                    path, spec, str(k))
    one = spark.createDataFrame([("7",)], "account_cbu string").withColumn(BUCKET, bucket_of(spec))
    buckets, bits = touched(one, spec)
    found = read_table(spark, path, spec, buckets=buckets, bits=bits)
    assert [r["account_label"] for r in found.collect()] == ["n7"]
    assert len({p.split("batch_folder=")[1].split("/")[0] for p in found.inputFiles()}) == 1


def test_backfill_counts_errors(spark, now, tmp_path):
    begin, end = (F.lit(dt.datetime(y, 1, 1)).cast("timestamp_ntz") for y in (2026, 2027))
    docs = landed(spark, doc(1), doc(2, date_created="2025-01-01"), "{broken", doc(3, date_created="never"))
    out = payments.backfill(spark, str(tmp_path), docs, ["seq"], begin, end, now, "b")
    assert (out["processed"], out["errors"], out["charges"]) == (1, 2, 2)


def pages(spark, kind, *records, account="ACC"):
    body = json.dumps({"movements_detail": list(records)})
    return spark.createDataFrame([("IB", "m", f"r-{kind}-{account}", account, "7", kind, 0, 100, AT, body)], PAGE_SCHEMA)


def test_movements_settle(spark, now, tmp_path):
    root = str(tmp_path)
    a, b = {"amount": 5, "process_date": "2026-06-01"}, {"amount": 6, "process_date": "2026-06-01"}
    bank.sync_same_day(spark, root, pages(spark, "dia", a, a, b), now, "1")
    first = table(spark, root, "ib_movements")
    ids = {r["movement_hash"]: r["movement_id"] for r in first.collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    bank.sync_same_day(spark, root, pages(spark, "dia", a, a, b, {"amount": 7}), now, "2")
    second = {r["movement_hash"]: r["movement_id"] for r in table(spark, root, "ib_movements").collect()}
    assert len(second) == 4 and ids.items() <= second.items()
    settled = pages(spark, "anteriores", {**a, "voucher_number": 1}, {**b, "voucher_number": 2})
    bank.sync_dataset(spark, root, settled, "movement", now, "3")
    bank.sync_same_day(spark, root, pages(spark, "dia"), now, "4")
    done = rows(table(spark, root, "ib_movements"))  # read now: the next write replaces files
    assert len(done) == 2 and table(spark, root, "ib_movements").where("movement_source = 'anteriores'").count() == 2
    bank.sync_dataset(spark, root, settled, "movement", now, "5")
    assert rows(table(spark, root, "ib_movements")) == done


def test_rows_without_label_get_one(spark, now, tmp_path):
    root, spec = str(tmp_path), SPECS["ib_movements"]
    p = pages(spark, "anteriores", {"amount": 5, "process_date": "2026-06-01"})
    old = bank.bank_rows(p, "movement", now).withColumn("movement_source", F.lit(None).cast("string"))
    write_table(old.withColumn("movement_id", F.lit(7).cast("bigint")), f"{root}/ib_movements", spec)
    bank.sync_dataset(spark, root, p, "movement", now, "1")
    got = table(spark, root, "ib_movements").collect()
    assert [(r["movement_id"], r["movement_source"]) for r in got] == [(7, "anteriores")]


def test_failed_account_keeps_its_rows(spark, now, tmp_path):
    root = str(tmp_path)
    feed = pages(spark, "dia", {"amount": 5}).unionByName(pages(spark, "dia", {"amount": 6}, account="B"))
    bank.sync_same_day(spark, root, feed, now, "1")
    scope = spark.createDataFrame([("ACC",)], "source_account string")
    bank.sync_same_day(spark, root, pages(spark, "dia"), now, "2", scope)
    left = table(spark, root, "ib_movements").collect()
    assert [r["source_account"] for r in left] == ["B"]


@pytest.mark.parametrize("dataset, name, body", [
    ("account", "ib_accounts", [{"cbu": "1", "numeroBanco": "007"}, {"cbu": "2"}]),
    ("balance", "ib_balances", [{"account_number": "1", "historical_balances": [{"operation_date": "2026-01-01"}]}]),
    ("transfer", "ib_transfers", [{"id": 1, "importe": 5}, {"transferId": 2}]),
    ("voucher", "ib_vouchers", [{"id": 1}, {"id": 2}]),
    ("extract", "ib_extracts", [{"statement_number": 1, "movement_detail": [{"amount": 1}]}, {"statement_number": 2}]),
])
def test_every_bank_table(spark, now, tmp_path, dataset, name, body):
    root = str(tmp_path)
    p = spark.createDataFrame([("IB", "e", "r", "ACC", "7", None, 0, 100, AT, json.dumps(body))], PAGE_SCHEMA)
    bank.sync_dataset(spark, root, p, dataset, now, "1")
    once = rows(table(spark, root, name))
    assert len(once) == 2 and table(spark, root, name).columns == table_schema(name).names
    bank.sync_dataset(spark, root, p, dataset, now, "2")
    again = table(spark, root, name)
    assert rows(again) == once
    surrogate = SPECS[name].surrogate
    if surrogate:
        assert sorted(r[0] for r in again.select(surrogate).collect()) == [1, 2]


def test_last_record_of_a_batch_wins(spark, now, tmp_path):
    spec = scaled_specs(4)["ib_accounts"]
    cols = ["account_cbu", *spec.update_cols]
    batch = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "account_cbu string, account_label string, n int")
    for c in cols:
        if c not in batch.columns:
            batch = batch.withColumn(c, F.lit(None).cast(spec.schema[c].dataType))
    upsert_table(spark, f"{tmp_path}/a", spec, batch, now, "b", ordinal=("n",))
    assert read_table(spark, f"{tmp_path}/a", spec).select("account_label").collect()[0][0] == "new"


def test_write_and_export(spark, tmp_path):
    spec = SPECS["ib_accounts"]
    df = spark.range(10).selectExpr("CAST(id AS STRING) AS account_cbu")
    write_table(df, f"{tmp_path}/t", spec)
    assert read_table(spark, f"{tmp_path}/t", spec).count() == 10
    broken = df.select(F.raise_error(F.lit("no access")).alias("x"))
    paths, left, failed = export_tables(
        {"a": df, "c": broken, "b": df}, f"{tmp_path}/out", {"b": ["account_cbu"]}, {"b": 3}
    )
    assert left == {"b": 7} and list(failed) == ["c"]
    assert spark.read.option("header", True).csv(paths["a"]).count() == 10
    assert [r[0] for r in spark.read.option("header", True).csv(paths["b"]).orderBy("account_cbu").collect()] == ["0", "1", "2"]


def test_a_writer_that_dies_leaves_every_old_row(spark, now, tmp_path, monkeypatch):
    """The write breaks off after the batch's files and before its commit, or while they are
    written: readers see the state before, and the batch can run again."""
    from finledger.sources import tables

    spec, path = SPECS["ib_accounts"], f"{tmp_path}/t"
    old = spark.range(50).selectExpr("CAST(id AS STRING) AS account_cbu", "'old' AS account_label")
    new = spark.range(25).selectExpr("CAST(id AS STRING) AS account_cbu", "'new' AS account_label")
    write_table(old, path, spec, "1")

    def state():
        return rows(read_table(spark, path, spec).select("account_cbu", "account_label"))

    before = state()
    with monkeypatch.context() as m:
        m.setattr(tables, "transact", lambda *a: a[3](0) and (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            write_table(new, path, spec, "2")
    assert state() == before
    with pytest.raises(Exception, match="half way"):
        write_table(new.withColumn("account_label", F.when(F.col("account_cbu") == "24", F.raise_error(F.lit("half way")))
                                   .otherwise("new")), path, spec, "2")
    assert state() == before
    write_table(new, path, spec, "2")
    assert sum(label == "new" for _, label in state()) == 25 and len(state()) == 50


def test_compaction_keeps_state_children_and_ids(spark, now, tmp_path):
    root = str(tmp_path)
    payments.apply_payments(spark, root, landed(spark, doc(1), doc(2)), ["seq"], now, "b1")
    payments.apply_payments(spark, root, landed(spark, doc(1, "2026-06-02", 0), doc(3)), ["seq"], now, "b2")
    from finledger.sources.tables import commits, compact_table, vacuum_table

    for name in ("mp_payments", "mp_payment_charges"):
        before = rows(table(spark, root, name))
        compact_table(spark, f"{root}/{name}", SPECS[name])
        assert vacuum_table(spark, f"{root}/{name}") == 2
        assert rows(table(spark, root, name)) == before
        assert len(commits(spark, f"{root}/{name}")) == 1
    payments.apply_payments(spark, root, landed(spark, doc(4)), ["seq"], now, "b3")
    ids = [r[0] for r in table(spark, root, "mp_payment_charges").select("charge_row_id").collect()]
    assert len(set(ids)) == len(ids) == 6 and max(ids) == 8


def test_seven_control_rows():
    assert len(CONTROL_SEED) == 7 and len({p for p, _ in CONTROL_SEED}) == 7


def test_an_audit_follows_commits(spark, tmp_path):
    root, names = str(tmp_path), ("ib_transfers", "ib_vouchers")
    specs = {n: scaled_specs(3)[n] for n in names}

    def put(name, *given):
        columns = "transfer_id bigint" + (", transaction_number string" if name == names[0] else "")
        write_table(spark.createDataFrame(list(given), columns), f"{root}/{name}", specs[name], "b")

    def same(expect_counted):
        kept = update_audit(spark, root, specs).collect()
        stored = {n: read_table(spark, f"{root}/{n}", specs[n]) for n in names}
        whole = {tuple(r) for r in audit.audit_constraints(stored, specs).collect()}
        assert {tuple(r)[:4] for r in kept} == whole
        assert {r["counted"] < r["audited"] for r in kept} == {not expect_counted}
        return {(r[0], r[1], r[2]): r[3] for r in kept}

    number, parent = (names[0], "unique", "transaction_number"), (names[1], "foreign_key", "transfer_id")
    assert same(True)[number] == 0  # no table has been written yet
    put(names[0], (1, "a"), (2, "a"), (3, None), (4, None))
    put(names[1], (1,), (1,), (7,), (8,))
    first = same(False)
    assert first[number] == 1 and first[parent] == 2 and first[(names[1], "unique", "transfer_id")] == 1
    put(names[0], (2, "b"), (7, "b"), (4, "a"))  # one clash goes, two come, a parent arrives
    then = same(False)
    assert then[number] == 2 and then[parent] == 1
    seen = snapshot(spark, root)
    same(False)
    assert snapshot(spark, root) == seen  # nothing new, nothing written
    compact_table(spark, f"{root}/{names[0]}", specs[names[0]])
    vacuum_table(spark, f"{root}/{names[0]}")
    put(names[0], (2, "a"), (8, "c"))
    last = same(False)  # a compaction changes nothing
    assert last[number] == 2 and last[parent] == 0
    put(names[0], (9, "c"))
    compact_table(spark, f"{root}/{names[0]}", specs[names[0]])
    vacuum_table(spark, f"{root}/{names[0]}")
    assert same(True)[number] == 3  # the batch was vacuumed before it was audited
    reset_table(spark, f"{root}/{names[0]}", specs[names[0]], "reset")
    assert same(True)[parent] == 4


def test_an_audit_needs_parents_stored_by_what_children_name(spark, tmp_path):
    specs = dict(scaled_specs(3))
    specs["ib_vouchers"] = replace(specs["ib_vouchers"], parent=("transfer_id", "ib_accounts", "bank_number"))
    with pytest.raises(ValueError, match="not stored by"):
        update_audit(spark, str(tmp_path), specs)
