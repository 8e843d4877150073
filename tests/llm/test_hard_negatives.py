import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from finledger.llm import hard_negatives, registry
from finledger.llm.hard_negatives import Rows, mine

SCHEMA = "vec_id bigint, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, positives=5, negatives=5):
    """All scores with Python integers."""
    kept = [
        (i, [int(np.floor(256 * x)) for x in v], k) for i, v, k in rows
        if i is not None and k is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
    ]
    kept = [r for n, r in enumerate(kept) if r not in kept[:n]]
    out = []
    for anchor in kept:
        if anchor[0] % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(anchor[1], r[1], strict=False)), r[0], n)
            for n, r in enumerate(kept) if r is not anchor
        )
        same = [s for s in scored if kept[s[2]][2] == anchor[2]][:positives]
        other = [s for s in scored if kept[s[2]][2] != anchor[2]]
        for p, pid, _ in same:
            window = [s for s in other if 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(anchor[0], pid, k, s[1], -p, -s[0]) for k, s in enumerate(window, 1)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def clustered(seed, n, width=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, width))
    at = rng.integers(0, len(centres), n)
    vectors = centres[at] + 0.4 * rng.normal(size=(n, width))
    vectors *= rng.choice([0.1, 0.5, 1.0], n)[:, None]
    label = np.where(rng.random(n) < 0.7, at % labels, rng.integers(0, labels, n))
    return [(int(i * 5), [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(vectors, label, strict=True))]


@pytest.mark.parametrize("shard_rows, block_anchors", [(4096, 1024), (50, 3)])
def test_against_all_pairs(spark, shard_rows, block_anchors):
    rows = clustered(1, 400)
    got = found(mine(spark.createDataFrame(rows, SCHEMA).repartition(3),
                     shard_rows=shard_rows, block_anchors=block_anchors))
    want = plain(rows)
    assert len(want) > 200 and got == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (100, [0.5, 0.5], 2), (1, [0.9, 0.1], 1), (2, [0.9, 0.1], 1),
        (3, [0.9, 0.1], 2), (4, [0.9, 0.1], 2), (5, [0.85, 0.3], 2), (6, [-1.0, 0.0], 1),
        (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 2), (9, None, 1), (10, [None, 1.0], 1), (11, [nan, 1.0], 2),
        (12, [inf, 1.0], 2), (13, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (14, [], 2), (15, [1.0], 2),
        (16, [0.9, 0.1, 4.0], 2), (0, [1.0, 0.0], 1), (4, [0.9, 0.1], 2), (4, [0.8, 0.0], 2),
        (200, [1.0, 1.0], 9), (-100, [0.7, 0.1], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "sum", "vec", "shard", "block", "a_id", "n", "a.b"):
        df = df.withColumn(name, F.lit(None).cast("int"))
    want = plain(rows)
    assert len(want) > 10 and found(mine(df.repartition(3), shard_rows=4, block_anchors=2)) == want
    assert found(mine(df.limit(0))) == []
    assert found(mine(df.where("vec_id % 100 <> 0"))) == []


def test_scores_that_doubles_would_round(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i * 20), [float(x) for x in rng.normal(size=4) * 3e5 + 1e6], int(i % 3)) for i in range(40)]
    want = plain(rows)
    assert max(r[4] for r in want) > 2**53
    assert found(mine(spark.createDataFrame(rows, SCHEMA), shard_rows=16)) == want
    huge = spark.createDataFrame([(0, [1e308, 1.0], 1), (1, [1e308, 2.0], 1), (2, [1e308, 3.0], 2)], SCHEMA)
    assert found(mine(huge)) == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


def test_threshold_join_is_exact_and_prunes():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(300, 40)) * 50 * rng.choice([0.05, 1], 300)[:, None])
    q = np.floor(rng.normal(size=(20, 40)) * 50)
    q[0] = 0
    scores = q @ x.T
    for least in (np.quantile(scores, 0.99, axis=1), np.quantile(scores, 0.2, axis=1), np.full(20, -np.inf)):
        asked = []
        a, r, s = Rows(x).at_least(q, least, lambda a, r, asked=asked: asked.append(len(a)) or a == a)
        got = sorted(zip(a.tolist(), r.tolist(), s.tolist(), strict=True))
        wa, wr = np.nonzero(scores >= least[:, None])
        assert got == sorted(zip(wa.tolist(), wr.tolist(), scores[wa, wr].tolist(), strict=True))
    least = np.full(20, scores.max())
    asked = []
    Rows(x).at_least(q, least, lambda a, r: asked.append(len(a)) or a == a)
    assert asked[0] < scores.size / 20  # most pairs never become candidates


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    name = "op13_l2ap_negatives"
    got = found(registry.QUERIES[name](spark, folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(con.execute(registry.SQL[name]).fetchall())
    assert got == want and want


def test_levels_reach_the_windows_end():
    assert hard_negatives.NEGATIVE_LEVELS[-1] > hard_negatives.LOW / hard_negatives.OF
