import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from finledger.functions import messages, redact, signed
from finledger.functions import scalars as X


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    by_column = df.select(fn(F.col("x"))).first()[0]
    as_text = fn("x") if kind == "string" else None
    if isinstance(as_text, str):
        assert df.selectExpr(as_text).first()[0] == by_column
    return by_column


@pytest.mark.parametrize("value, expected", [
    (None, None), ("", None), ("   ", None), ("abc", "abc"), ("  abc \t\n", "abc"),
    (" x　", "x"), ("0", "0"), ("12345.0", "12345"), ("12345.50", "12345.50"), (" 7.00 ", "7"),
])
def test_to_str(spark, value, expected):
    assert one(spark, value, X.to_str) == expected


def test_to_str_of_numbers(spark):
    assert one(spark, 123, X.to_str, "int") == "123"
    assert one(spark, 0, X.to_str, "int") == "0"
    assert one(spark, 12345.0, X.to_str, "double") == "12345"


@pytest.mark.parametrize("value, expected", [
    ("1", True), ("TRUE", True), (" t", True), ("yes", True), ("si", True), ("SÍ", True),
    ("0", False), ("False", False), ("f", False), ("no", False), ("maybe", None), ("", None), (None, None),
])
def test_to_bool(spark, value, expected):
    assert one(spark, value, X.to_bool) is expected


def test_number_to_bool(spark):
    assert one(spark, -2.0, X.number_to_bool, "double") is True
    assert one(spark, 0.0, X.number_to_bool, "double") is False
    assert one(spark, float("nan"), X.number_to_bool, "double") is None


@pytest.mark.parametrize("value, dropped, shifted", [
    ("2026-05-27T07:03:35.000-04:00", dt.datetime(2026, 5, 27, 7, 3, 35), dt.datetime(2026, 5, 27, 11, 3, 35)),
    ("2026-05-27", dt.datetime(2026, 5, 27), dt.datetime(2026, 5, 27)),
    (" 2026-05-27 ", dt.datetime(2026, 5, 27), dt.datetime(2026, 5, 27)),
    ("27/05/2026", dt.datetime(2026, 5, 27), None),
    ("05/06/2026", dt.datetime(2026, 5, 6), None),
    ("20260527", dt.datetime(2026, 5, 27), None),
    ("soon", None, None), ("", None, None), (None, None, None),
])
def test_timestamps(spark, value, dropped, shifted):
    assert one(spark, value, X.parse_ts_drop_zone) == dropped
    assert one(spark, value, X.parse_ts_utc) == shifted


def test_hash_keeps_positions(spark):
    df = spark.createDataFrame([("a", None, " c ")], "a string, b string, c string")
    got = df.select(X.sha256_of_parts(*[F.col(c) for c in "abc"])).first()[0]
    assert got == hashlib.sha256(b"a||c").hexdigest()
    assert got == df.selectExpr(X.sha256_of_parts("a", "b", "c")).first()[0]


def test_canonical_text_does_not_depend_on_spelling(spark):
    df = spark.createDataFrame([("116506",), ("116506.0",), (" 116506.00",)], "x string")
    assert {r[0] for r in df.select(X.canonical_amount(F.col("x"))).collect()} == {"116506.00"}
    df = spark.createDataFrame([("2026-05-27",), ("2026-05-27T00:00:00",)], "x string")
    assert len({r[0] for r in df.select(X.canonical_ts(F.col("x"))).collect()}) == 1


def test_falsy_fallback(spark):
    df = spark.createDataFrame([(0, 5), (None, 5), (7, 5), (0, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(X.first_nonzero(F.col("a"), F.col("b"))).collect()] == [5, 5, 7, None]


def test_diff_counts_boundaries(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-01 00:00:59' a, timestamp_ntz'2026-01-01 00:01:01' b")
    assert df.select(X.diff_boundaries("MINUTE", F.col("a"), F.col("b"))).first()[0] == 1


def test_json_text_keeps_nulls_and_accents(spark):
    df = spark.sql("SELECT named_struct('a', 'ñandú', 'b', CAST(NULL AS STRING)) s")
    assert df.select(X.to_json_text(F.col("s"))).first()[0] == '{"a":"ñandú","b":null}'


def redacted(spark, doc):
    df = spark.createDataFrame([(doc,)], "body string")
    text = df.selectExpr(redact.redact_payment("body")).first()[0]
    return None if text is None else json.loads(text)


def test_redact_payment(spark):
    doc = {
        "id": 1, "unknown": {"x": [1, None]},
        "payer": {"email": "a@b", "id": 5, "phone": None, "identification": {"type": "T", "number": "9"}},
        "card": {"first_six_digits": "1", "last_four_digits": "2", "cardholder": {"name": "n"}},
        "metadata": {"a": 1}, "additional_info": {"payer": {"x": 1}, "items": [{"id": "i"}]},
    }
    out = redacted(spark, json.dumps(doc))
    m = redact.MARKER
    assert out["payer"] == {"email": m, "id": 5, "phone": None, "identification": {"type": "T", "number": m}}
    assert out["card"] == {"first_six_digits": m, "last_four_digits": m, "cardholder": {"name": m}}
    assert out["metadata"] == m
    assert out["additional_info"] == {"payer": m, "items": [{"id": "i"}]}
    assert out["unknown"] == {"x": [1, None]} and out["id"] == 1


def test_redact_other_shapes(spark):
    m = redact.MARKER
    assert redacted(spark, '[{"metadata":1},5,{"a":1}]') == [{"metadata": m}, 5, {"a": 1}]
    assert redacted(spark, "5") == 5
    assert redacted(spark, '{"payer":"text"}') == {"payer": "text"}
    assert redacted(spark, "{broken") is None
    assert redacted(spark, None) is None


def test_redact_bank_leaves_the_rest(spark):
    df = spark.createDataFrame([("1", None, 5.0)], "account_cuit string, customer_cuit string, amount double")
    assert tuple(redact.redact_bank(df).first()) == (redact.MARKER, None, 5.0)


def test_messages(spark):
    df = spark.createDataFrame(
        [("sync job_x OK: read=3 upserted=2 duration_ms=15",), ("[1] HMAC inválido (ts_too_old(301s)) para event_type=payment",),
         ("other",)], "m string",
    )
    sync = [tuple(r[0]) for r in df.select(messages.parse_sync_message(F.col("m"))).collect()]
    reject = [tuple(r[0]) for r in df.select(messages.parse_reject_message(F.col("m"))).collect()]
    assert sync == [("job_x", 3, 2, 15), (None,) * 4, (None,) * 4]
    assert reject == [(None, None), ("ts_too_old(301s)", "payment"), (None, None)]


def test_published_hmac_vector(spark):
    """RFC 4231, test case 2."""
    df = spark.createDataFrame([("what do ya want for nothing?",)], "t string")
    got = df.select(signed.sign_with("Jefe")(F.col("t"))).first()[0]
    assert got == "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"
