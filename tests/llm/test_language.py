import random
import zlib
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from finledger.llm import language, registry

from .edge import CLASHING, LONG, TEXTS


class PlainTree:
    """One language's contexts as dictionaries, walked byte by byte."""

    def __init__(self, texts):
        self.seen = defaultdict(Counter)
        for text in texts:
            data = b" " * 4 + text
            for i in range(4, len(data)):
                for order in range(5):
                    self.seen[data[i - order:i]][data[i]] += 1

    def bits(self, text):
        data, total = b" " * 4 + text, 0.0
        for i in range(4, len(data)):
            for order in (4, 3, 2, 1, 0, None):
                if order is None:
                    total += 8
                    break
                after = self.seen.get(data[i - order:i])
                if not after:
                    continue
                whole = sum(after.values()) + len(after)
                if data[i] in after:
                    total -= log2(after[data[i]] / whole)
                    break
                total -= log2(len(after) / whole)
        return total


def held_out(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 5 == 0


def plain(rows):
    """(key, held_out, lang_pred, score) by walking dictionaries."""
    texts = defaultdict(set)
    for key, text, lang in rows:
        if text and lang is not None and not held_out(key):
            texts[lang].add(text)
    trees = {lang: PlainTree(t.lower().encode() for t in own) for lang, own in sorted(texts.items())}
    out = []
    for key, text, _ in rows:
        if not trees or not any(c.isalpha() for c in text or ""):
            out.append((key, held_out(key), "und", 0.0))
            continue
        bits = {lang: tree.bits(text.lower().encode()) for lang, tree in trees.items()}
        best = min(bits, key=lambda lang: (round(bits[lang], 3), lang))
        out.append((key, held_out(key), best, 1 / sum(2 ** -(b - bits[best]) for b in bits.values())))
    return sorted(out, key=repr)


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    return df.withColumns({c: F.lit(None).cast("int") for c in [*CLASHING, "texts", "sum", "a.b"]})


def check(spark, rows, **settings):
    got = language.identify_languages(table(spark, rows), **settings)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (repr(r[:3]), r[3]))
    want = sorted(plain(rows), key=lambda r: (repr(r[:3]), r[3]))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=2e-3)


def sentences(seed, n):
    """Invented words of three languages over overlapping letters."""
    rng = random.Random(seed)
    parts = {"aa": ["ki", "ra", "lo", "né"], "bb": ["ki", "sch", "lo", "ung"], "cc": ["日本", "語", "ra", "x"]}
    out = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(1, 12))]
        out.append((i, " ".join(words).title(), lang))
    return out


def test_code_lengths_against_a_walked_tree():
    rng = random.Random(1)
    train = [bytes(rng.choices(b"abcd \xc3\xa9", k=200)) for _ in range(6)]
    counts = Counter()
    for lang, text in enumerate(train):
        data = b" " * 4 + text
        for i in range(4, len(data)):
            for size in range(1, 6):
                counts[lang % 2, size, int.from_bytes(data[i - size + 1:i + 1])] += 1
    arrays = tuple(np.array(c) for c in zip(*[(*k, n) for k, n in counts.items()], strict=True))
    trees = language.Trees(["x", "y"], arrays)
    texts = [b"", b"a", b"zzzz", b"abcabcabc", b"\xff\x00q", *train, b"abc dz" * 300]
    want = [[PlainTree(train[k::2]).bits(t) for k in range(2)] for t in texts]
    assert np.allclose(trees.code_lengths(texts), want, rtol=1e-4)
    whole = trees.code_lengths(texts)
    language.AT_ONCE, before = 64, language.AT_ONCE  # long texts in pieces code alike
    try:
        assert np.allclose(trees.code_lengths(texts), whole, rtol=1e-5)
    finally:
        language.AT_ONCE = before


def test_against_walked_trees(spark):
    check(spark, sentences(2, 150))


def test_edge_rows(spark):
    rows = [(k, t, "en") for k, t in TEXTS] + [(90 + i, t, k) for i, (_, t, k) in enumerate(sentences(3, 30))]
    rows += [(200, LONG, None), (201, "12 34 .,;", "en"), (202, "日", None), (None, "ki ra lo", "aa"), (203, "é", None)]
    check(spark, rows)
    none = [(1, "abc", None), (2, None, "en"), (5, "abc def", None)]
    check(spark, none)
    assert language.identify_languages(table(spark, none).limit(0)).collect() == []


def test_sample_and_room_bound_the_model(spark):
    df = table(spark, sentences(4, 300))
    trees = language.train(df, sample=20, model_costs=3 * 100)
    assert sum(len(c) for c in trees.costs) <= 100
    whole = language.train(df)
    assert sum(len(c) for c in whole.costs) > 300
    # a held-out document changes nothing, nor does a repeated text
    extra = table(spark, [(k, "only here zzz", "aa") for k in range(400) if held_out(k)])
    again = language.train(df.union(extra).union(df))
    assert [len(c) for c in again.costs] == [len(c) for c in whole.costs]
    assert all(np.array_equal(a, b) for a, b in zip(again.costs, whole.costs, strict=True))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, folder):
    got = registry.QUERIES["op11_ppm_languages"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert got.count() == docs.count()
