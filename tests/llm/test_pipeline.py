"""The registered queries and the pipeline over the given tables, against brute force."""

import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from finledger.llm.common import stored

from .test_recompression import COLUMNS, brute
from .test_simhash import groups, plain_fingerprint

DATA = os.environ.get("FINLEDGER_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_every_operator_has_one_query():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


def test_repeats_and_copies_of_the_given_documents(spark):
    docs = rows_of(spark.read.parquet(f"{DATA}/documents.parquet"))
    got = entry_points.queries()["op1_recompression"](spark, DATA).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == brute(docs)
    prints = [plain_fingerprint(t or "") for _, t in docs]
    want = {k: g for (k, _), g in zip(docs, groups([k for k, _ in docs], prints), strict=True)}
    got = entry_points.queries()["op9_simhash_variants"](spark, DATA).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_vectors_of_the_given_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in table], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {r.vec_id: int(n) - 1 for r, n in zip(table, (x @ x.T >= 0.9).sum(axis=1), strict=True)}
    got = {r.vec_id: r.n_links for r in entry_points.queries()["op3_hnsw"](spark, DATA).collect()}
    assert got.keys() == want.keys()
    assert sum(got.values()) >= 0.9 * sum(want.values()) and all(got[k] <= want[k] for k in want)


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(stored(stage(spark, states[-1], DATA), name.replace(" ", "-")))
    assert all(s.columns == columns for s in states[:-1])
    texts = [dict(rows_of(s)) for s in states[:-1]]
    # 1: only rows go, and no good labelled one
    assert texts[1].items() <= texts[0].items()
    good = [r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1").collect()]
    assert sum(k in texts[1] for k in good) >= 0.95 * len(good)
    # 2: the first of each group stays
    before = sorted(texts[1].items())
    firsts = groups([k for k, _ in before], [plain_fingerprint(t) for _, t in before])
    assert texts[2] == {k: t for (k, t), g in zip(before, firsts, strict=True) if k == g}
    # 3: the words that brute force keeps
    want = {r[0]: r[3] for r in brute(list(texts[2].items()))}
    import hashlib
    assert {k: hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for k, t in texts[3].items()} == want
    # 4: no pattern is left, and texts without personal data are untouched
    from finledger.llm import pii
    assert not any(pii.base_spans(t) for t in texts[4].values())
    assert all(texts[4][k] == t or pii.MARKED.search(t) for k, t in texts[3].items())
    # 5: every document is there, whole
    whole = defaultdict(list)
    for r in states[-1].collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        whole[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert whole.keys() == texts[4].keys()
    for parts in whole.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total
    lengths = [n for r in states[1:-1] for n in [r.where("n_chars <> length(text)").count()]]
    assert lengths == [0] * len(lengths)
