import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from finledger.plans import alerts
from finledger.schemas import SPECS
from finledger.sources.tables import read_table
from finledger.streaming import jobs, triage

SECRET = "s3cret"
AT = dt.datetime(2026, 6, 1, 12)
MS = int(AT.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def signature(data_id, request_id, ts, secret=SECRET):
    text = f"id:{data_id};request-id:{request_id};ts:{ts};"
    return hmac.new(secret.encode(), text.encode(), hashlib.sha256).hexdigest()


def event(body='{"type":"payment","data":{"id":"5"}}', header=None, request="r", ts=MS, data_id="5"):
    if header is None:
        header = f"ts={ts},v1={signature(data_id, request, ts)}"
    return (body, header, request, AT)


@pytest.mark.parametrize("case, code, reason", [
    (event(), 202, "accepted"),
    (event(header=f" v1 = {signature('5', 'r', MS)} , ts = {MS}"), 202, "accepted"),
    (event('{"topic":"payment","id":5}'), 202, "accepted"),
    (event("{broken"), 400, "invalid_json"),
    (event("[1]"), 400, "invalid_json"),
    (event(""), 401, "missing_data_id"),
    (event(header=""), 401, "missing_x_signature"),
    (event(request=""), 401, "missing_x_request_id"),
    (event(request=None), 401, "missing_x_request_id"),
    (event('{"type":"payment"}'), 401, "missing_data_id"),
    (event('{"type":"payment","data":{"id":0}}'), 401, "missing_data_id"),
    (event(header="v1=abc"), 401, "malformed_x_signature"),
    (event(header="nonsense"), 401, "malformed_x_signature"),
    (event(header="ts=soon,v1=abc"), 401, "ts_not_integer"),
    (event(ts=MS - 300_000), 202, "accepted"),
    (event(ts=MS - 301_000), 401, "ts_too_old(301s)"),
    (event(ts=MS + 301_000), 401, "ts_in_future(-301s)"),
    (event(header=f"ts={MS},v1={signature('5', 'r', MS, 'other')}"), 401, "hmac_mismatch"),
    (event('{"type":"invoice","data":{"id":"5"}}'), 200, "ignored"),
    (event('{"data":{"id":"5"}}'), 200, "ignored"),
])
def test_triage(spark, case, code, reason):
    out = triage.triage_events(spark.createDataFrame([case], triage.EVENT_DDL), SECRET).first()
    assert (out["status_code"], out["reason"]) == (code, reason)
    assert triage.payment_ids(triage.triage_events(spark.createDataFrame([case], triage.EVENT_DDL), SECRET)).count() == (code == 202)


def test_secret_is_not_in_the_plan(spark):
    df = triage.triage_events(spark.createDataFrame([event()], triage.EVENT_DDL), SECRET)
    assert SECRET not in df._jdf.queryExecution().toString()


def write_json(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def doc(i, version, charges=1):
    return json.dumps({"id": i, "date_last_updated": version, "charges_details": [{"id": str(k)} for k in range(charges)]})


def test_upsert_stream_equals_batches(spark, now, tmp_path):
    source = tmp_path / "in"
    write_json(source, "1.json", [{"seq": 1, "body": doc(1, "2026-01-01")}, {"seq": 2, "body": "{broken"},
                                  {"seq": 3, "body": '{"x":1}'}])

    def run():
        landed = spark.readStream.schema("seq INT, body STRING").json(str(source))
        jobs.upsert_stream(landed, f"{tmp_path}/out", f"{tmp_path}/ck", ["seq"], lambda b: now).awaitTermination()

    run()
    write_json(source, "2.json", [{"seq": 4, "body": doc(1, "2026-01-02", 3)}, {"seq": 5, "body": doc(2, "2026-01-01")},
                                  {"seq": 6, "body": doc(2, "2026-01-01")}])
    run()
    run()
    payments = read_table(spark, f"{tmp_path}/out/mp_payments", SPECS["mp_payments"])
    charges = read_table(spark, f"{tmp_path}/out/mp_payment_charges", SPECS["mp_payment_charges"])
    assert sorted(r[0] for r in payments.select("payment_id").collect()) == [1, 2]
    assert {r[0]: r[1] for r in charges.groupBy("payment_id").count().collect()} == {1: 3, 2: 1}
    dead = spark.read.parquet(f"{tmp_path}/out/dead_letters")
    assert sorted(r["error"] for r in dead.collect()) == ["invalid_json", "missing_id"]


def events(spark, path, minutes, key="j"):
    path.mkdir(exist_ok=True)
    data = [(key, AT + dt.timedelta(minutes=m), m) for m in minutes]
    spark.createDataFrame(data, "k string, ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema("k string, ts timestamp_ntz, v double").parquet(str(path))


def test_feeds_collapse(spark, tmp_path):
    a, b = events(spark, tmp_path / "a", [0.0, 1.0, 2.0]), events(spark, tmp_path / "b", [1.0, 2.0, 3.0])
    jobs.run_to_table(jobs.merge_feeds(a, b, ["v"], "ts", "1 hour"), f"{tmp_path}/o", f"{tmp_path}/c")
    assert sorted(r["v"] for r in spark.read.parquet(f"{tmp_path}/o").collect()) == [0.0, 1.0, 2.0, 3.0]


def test_metrics_over_several_micro_batches(spark, tmp_path):
    for part in ([0.0, 6.0], [1.0, 7.0, 12.0]):
        stream = events(spark, tmp_path / "in", part)
        metrics = jobs.tumbling_metrics(stream, "ts", "5 minutes", "1 hour", {"n": F.count("v"), "s": F.sum("v")})
        jobs.run_to_table(metrics, f"{tmp_path}/o", f"{tmp_path}/c", "update")
    got = jobs.latest_state(spark, f"{tmp_path}/o", ["window_start"])
    assert {(r["window_start"].minute, r["n"], r["s"]) for r in got.collect()} == {(0, 2, 1.0), (5, 2, 13.0), (10, 1, 12.0)}


def test_threshold_stream_agrees_with_batch(spark, tmp_path):
    stream = events(spark, tmp_path / "in", [0.1 * i for i in range(9)] + [40.0])
    rule = alerts.SERVER_ERRORS
    jobs.run_to_table(jobs.threshold_stream(stream, "ts", rule, "1 minute"), f"{tmp_path}/o", f"{tmp_path}/c")
    got = spark.read.parquet(f"{tmp_path}/o")
    batch = alerts.threshold_alert(spark.read.parquet(str(tmp_path / "in")), "ts", rule)
    key = ["window_start", "window_end", "value"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))


def test_absence_stream(spark, tmp_path):
    def run(minutes, key):
        stream = events(spark, tmp_path / "in", minutes, key)
        jobs.run_to_table(jobs.absence_stream(stream, "k", "ts", 30, "1 minute"), f"{tmp_path}/o", f"{tmp_path}/c")

    run([0.0, 10.0], "quiet")
    run([20.0, 60.0], "busy")
    run([70.0], "busy")
    got = [(r["key"], r["silent_since_ms"]) for r in spark.read.parquet(f"{tmp_path}/o").collect()]
    assert ("quiet", MS + 600_000) in got
