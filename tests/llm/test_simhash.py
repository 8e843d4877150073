import random

import numpy as np
import pytest
import xxhash

from finledger.llm import simhash
from finledger.llm.components import components

from .edge import TEXTS, collected, documents


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, prints):
    """Smallest key reachable, by comparing all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 4
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None], len(prints)).min(axis=1)
        if (new == label).all():
            break
        label = new
    return [
        min((k for k, other in zip(keys, label, strict=True) if other == mine and k is not None),
            default=None)
        for mine in label
    ]


def check(spark, rows, **settings):
    prints = [plain_fingerprint(t or "") for _, t in rows]
    want = [
        (k, f"{p:016x}", g)
        for (k, _), p, g in zip(rows, prints, groups([k for k, _ in rows], prints), strict=True)
    ]
    got = simhash.near_duplicates(documents(spark, rows), **settings)
    assert collected(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


def test_edge_rows(spark):
    check(spark, TEXTS)


@pytest.mark.parametrize("hot", [1024, 2])
def test_near_copies_against_all_pairs(spark, hot):
    rng = random.Random(4)
    rows = []
    for i in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 150))]
        for j in range(12):
            own = list(words)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(500)}"
            rows.append((i * 100 + j, " ".join(own)))
    check(spark, rows, hot=hot)


def test_links_of_dense_fingerprints(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for base in rng.integers(0, 2**63, 20, dtype=np.uint64):
        for _ in range(20):
            x = int(base)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = groups(signed, prints)
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    for hot in (1024, 3):
        links = simhash.link_fingerprints(df, hot)
        found = {r.node: r.component for r in components(links, "a", "b").collect()}
        assert [found.get(s, s) for s in signed] == want


def test_keep_first_keeps_columns_and_one_of_a_group(spark):
    docs = documents(spark, [(2, "a b c d e"), (1, "A B C D E"), (3, "x y z u v w"), (None, "a b c d e")])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert collected(kept, "doc_id") == sorted([(1,), (3,), (None,)], key=repr)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_components_of_a_long_path_and_odd_links(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    df = spark.createDataFrame(
        [*path, (7, 7), (9, 3), (3, 9), (3, 9), (None, 4), (5, None)], "a bigint, b bigint"
    )
    found = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert found == {i: 100 for i in range(100, 161)} | {7: 7, 3: 3, 9: 3}
    assert components(df.limit(0), "a", "b").collect() == []


def test_keep_first_keeps_columns_with_dots(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5), (2, "a b c d e", 6)], "doc_id bigint, text string, `a.b` int")
    assert [tuple(r) for r in simhash.keep_first(df).collect()] == [(1, "a b c d e", 5)]
