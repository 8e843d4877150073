import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finledger.llm.sharding import jump_walk, shard_documents

from .edge import TEXTS, documents


def jump(key, shards):
    """The published loop, on unsigned 64-bit numbers."""
    key, at, after = key % 2**64, -1, 0
    while after < shards:
        at = after
        key = (key * 2862933555777941757 + 1) % 2**64
        after = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=50, max_size=200))
def test_walk_is_the_published_one(spark, keys):
    keys += [0, 1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 24):
        got = df.select("k", jump_walk(F.col("k"), n).alias("w")).collect()
        assert all(r.w.stop == jump(r.k, n) for r in got)
        assert all((n if r.w.next == n else r.w.stop) == jump(r.k, n + 1) for r in got)


def test_edge_rows(spark):
    got = shard_documents(documents(spark), 5).collect()
    want = sorted(
        (k is None, k or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
        for k, t in TEXTS
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "key" and r.shard == jump(r.doc_id or 0, 5)
        assert r.grown_shard == jump(r.doc_id or 0, 6)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_many_copies_of_one_row_get_a_slot_each(spark):
    rows = spark.range(10_000).selectExpr("7L AS doc_id", "'same' AS text")
    slots = [r.slot for r in shard_documents(rows).collect()]
    assert sorted(slots) == list(range(10_000))


def test_empty_table(spark):
    assert shard_documents(documents(spark, [])).collect() == []
