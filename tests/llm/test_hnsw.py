import numpy as np
import pytest

from finledger.llm import hnsw


def clustered(seed, n, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 15, dim))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * 0.18
    return x.astype(np.float32)


def near(x):
    u = hnsw.unit(x)
    return u @ u.T >= 0.9


def labels(adjacent, ids):
    ids = np.array(ids)
    label = ids.copy()
    while True:
        new = np.where(adjacent, label[None], ids.max() + 1).min(axis=1)
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def test_recall_of_one_graph():
    x = clustered(1, 3000)
    ids = np.arange(3000) * 3 - 500
    graph = hnsw.Graph.unpacked(hnsw.build(ids, x, np.ones(3000, dtype=np.int64)).packed())
    found = list(hnsw.audited_hits(graph, ids, x, 0.9, 32, 0.99, 64))
    true = near(x)
    got = sum(len(f) for f in found)
    position = np.argsort(graph.ids)
    for i, f in enumerate(found[:200]):
        assert true[i][np.searchsorted(ids, graph.ids[f])].all()
    assert got >= 0.97 * true.sum() and (np.diff(graph.ids[position]) > 0).all()


def test_a_dense_cluster_widens_its_beams():
    rng = np.random.default_rng(2)
    x = np.concatenate([clustered(3, 600), rng.normal(size=(1, 24)) + rng.normal(size=(700, 24)) * 0.02])
    graph = hnsw.build(np.arange(1300), x, np.ones(1300, dtype=np.int64))
    found = list(hnsw.audited_hits(graph, np.arange(1300), x, 0.9, 16, 0.99, 64))
    true = near(x).sum(axis=1)
    assert sum(map(len, found)) >= 0.98 * true.sum()


@pytest.mark.parametrize("shard_rows", [1 << 16, 120])
def test_table_against_all_pairs(spark, shard_rows):
    x = clustered(5, 400)
    rows = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (3, rows[3][1])]  # copies, and a repeated row
    odd = [(600, None), (601, []), (602, [0.0] * 24), (603, [None] + [1.0] * 23),
           (604, [float("nan")] + [1.0] * 23), (605, [float("inf")] + [1.0] * 23), (None, rows[3][1]),
           (606, [1.0, 0.0]), (607, [2.0, 0.0]), (608, [1e-30] * 24)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "1 AS rep", "2 AS block", "3 AS links", "4 AS vector", "5 AS key"
    )
    got = hnsw.near_vectors(df.repartition(3), shard_rows=shard_rows).collect()
    assert len(got) == len(rows) + len(odd)
    ids = [r[0] for r in rows[:402]]
    vectors = np.array([r[1] for r in rows[:402]], dtype=np.float32)
    ids += [608]
    vectors = np.concatenate([vectors, np.full((1, 24), 1e-30, dtype=np.float32)])
    adjacent = near(vectors)
    want = {k: (int(a.sum()) - 1, int(c)) for k, a, c in
            zip(ids, adjacent, labels(adjacent, ids), strict=True)}
    want |= {k: (0, k) for k in range(600, 606)} | {606: (1, 606), 607: (1, 606), None: (0, None)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_one_key_with_several_vectors(spark):
    rows = [(3, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.01]), (4, [1.0, 0.01]), (2, [0.02, 1.0]), (9, [1.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in hnsw.near_vectors(df).collect())
    # 3 twice: once beside 4 and 9, once beside 2
    assert got == [(2, 1, 2), (3, 1, 2), (3, 2, 3), (4, 2, 3), (4, 2, 3), (9, 2, 3)]


def test_a_crowded_key_keeps_its_vectors_apart(spark):
    x = clustered(8, 300)
    df = spark.createDataFrame(
        [(7 if i % 3 else i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = hnsw.near_vectors(df, shard_rows=64).collect()
    want = sorted((7 if i % 3 else i, int(n) - 1) for i, n in enumerate(near(x).sum(axis=1)))
    assert sorted((r.vec_id, r.n_links) for r in got) == want


def test_links_count_at_both_sides(spark):
    """Without an audit and with the narrowest beam links are missed, but none at one side only."""
    x = clustered(9, 600)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r for r in hnsw.near_vectors(df, shard_rows=150, beam=2, audited=0).collect()}
    assert sum(r.n_links for r in got.values()) % 2 == 0
    alone = {k for k, r in got.items() if r.n_links == 0}
    sizes = {}
    for r in got.values():
        sizes[r.component_id] = sizes.get(r.component_id, 0) + 1
    assert all((sizes[r.component_id] == 1) == (k in alone) for k, r in got.items())


def test_an_audit_weighs_queries_not_links():
    rng = np.random.default_rng(4)
    crowd = rng.normal(size=(1, 24)) + rng.normal(size=(900, 24)) * 0.02
    twins = rng.normal(size=(300, 24))
    x = np.concatenate([crowd, twins, twins + rng.normal(size=twins.shape) * 0.02])
    graph = hnsw.build(np.arange(len(x)), x, np.ones(len(x), dtype=np.int64))
    truth = hnsw.audit(graph, np.arange(len(x)), x, 0.9, 64)
    assert len(truth) == 64 and len({len(real) for _, real in truth}) > 1
    assert all(set(np.flatnonzero(near(x)[i])) == set(graph.ids[real]) for i, real in truth[:8])
    found = list(hnsw.audited_hits(graph, np.arange(len(x)), x, 0.9, 4, 0.99, 64))
    assert np.mean([len(f) == 2 for f in found[900:]]) >= 0.95


def test_marked_pairs_count_from_both_sides():
    rng = np.random.default_rng(7)
    a, b = (hnsw.Graph(np.arange(n) + base, rng.normal(size=(n, 3)), rng.integers(1, 4, n), []) for n, base in ((1100, 0), (21, 5000)))
    truth, pairs = rng.random((1100, 21)) < 0.002, hnsw.Pairs(a, b)
    for row in range(0, 1100, 2):
        pairs.add(row, np.flatnonzero(truth[row]))
    for column in range(21):
        pairs.add(np.flatnonzero(truth[:, column]), column)
    rows, columns = pairs.links()
    assert (rows == truth @ b.copies).all() and (columns == a.copies @ truth).all()
    x, y = pairs.tied()
    root = {n: n for n in [*a.ids.tolist(), *b.ids.tolist()]}
    def top(n):
        while root[n] != n:
            n = root[n]
        return n
    for p, q in zip(x.tolist(), y.tolist(), strict=True):
        root[max(top(p), top(q))] = min(top(p), top(q))
    assert all(top(int(p)) == top(5000 + int(q)) for p, q in zip(*np.nonzero(truth), strict=True))


def test_planted_links_in_the_given_table(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(path).collect() if r.embedding]
    rng = np.random.default_rng(6)
    near_ones = [(10**6 + k, [float(v) for v in np.array(x) + rng.normal(size=len(x)) * 0.02 * np.std(x)])
                 for k, x in rows[::3]]
    df = spark.createDataFrame(rows + near_ones, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_vectors(df, shard_rows=100).collect()}
    ids = [k for k, _ in rows + near_ones]
    adjacent = near(np.array([x for _, x in rows + near_ones], dtype=np.float32))
    true = adjacent.sum() - len(ids)
    assert true >= 2 * len(near_ones) > 0
    assert sum(n for n, _ in got.values()) >= 0.99 * true
    assert sum(got[k][1] == c for k, c in zip(ids, labels(adjacent, ids), strict=True)) >= 0.99 * len(ids)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert hnsw.near_vectors(df).collect() == []
