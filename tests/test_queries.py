"""Every registered query against its SQL twin on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("FINLEDGER_TEST_DATA", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    return v.isoformat() if isinstance(v, (dt.datetime, dt.date)) else v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, oracle, name):
    df = entry_points.queries()[name](spark, DATA)
    got = table(df.columns, df.collect())
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    cursor = oracle.execute(sql)
    assert got == table([c[0] for c in cursor.description], cursor.fetchall())


def test_triage_accepts_only_genuine_notifications(spark):
    rows = entry_points.queries()["triage_events"](spark, DATA)
    forged = rows.where("event_id % 2 = 1 AND reason IN ('accepted', 'ignored')")
    genuine = rows.where("event_id % 2 = 0 AND reason = 'hmac_mismatch'")
    assert rows.where("reason = 'accepted'").count() > 0
    assert forged.count() == 0 and genuine.count() == 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["day", "payments"]
