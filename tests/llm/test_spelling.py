import random
import re
import zlib
from collections import Counter

import pytest

from finledger.llm import registry, spelling

from .edge import LONG, TEXTS, documents

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counts_of(rows, every):
    total = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return total


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, every=None, ratio=10):
    words = {w: n for w, n in counts_of(rows, every).items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, letters, words, n):
    """Documents over a few words, their one-edit neighbours and neighbours of those."""
    rng = random.Random(seed)
    known, weights = [], []
    for _ in range(words):
        word = [rng.choice(letters) for _ in range(rng.randrange(8, 13))]
        for weight in (3000, 200, 12, 4, 2):
            known.append("".join(word))
            weights.append(weight)
            at = rng.randrange(len(word))
            word[at:at + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
    return [(i, " ".join(rng.choices(known, weights, k=200)).title()) for i in range(n)]


@pytest.mark.parametrize("letters, tile_rows", [("ab", 2048), ("ab", 3), ("abé÷z", 40)])
def test_against_all_pairs(spark, letters, tile_rows):
    rows = corpus(1, letters, 12, 60)
    want = plain(rows, 31)
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] and r[1] != r[2] for r in want)
    df = documents(spark, rows)
    assert found(spelling.spelling_variants(df, altered_every=31, tile_rows=tile_rows)) == want


def test_edge_rows(spark):
    long = "q" + "ab" * 3000
    rows = [
        *TEXTS, (20, f"{long} {long} {long}x {long}x x{long} x{long}"), (21, "straßen Straßen straszen"),
        (22, "ÀÉÎÕÜxy ÀÉÎÕÜxy àéîõüxy àéîõüxy"), (23, "sevenab,sevenab;sevenabc_sevenabc" * 2),
        (24, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"), (25, "日本日本日本日本"), (26, LONG.upper()),
        (None, "nullkey nullkey nullkeys nullkeys"), (None, "nullkey"),
    ]
    df = documents(spark, rows)
    for every in (None, 2):
        assert found(spelling.spelling_variants(df, altered_every=every)) == plain(rows, every)
    assert found(spelling.spelling_variants(df.limit(0))) == []


def test_tile_and_pairs_agree_on_small_alphabets():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 9))) for _ in range(200)})
    left, right, sizes = spelling.matrices(words, 8)
    import numpy as np

    longer, all_ = np.flatnonzero(sizes == 8), np.arange(len(words))
    x, y, _ = spelling.tile(left, right, longer, all_)
    got = {(words[a], words[b]) for a, b in zip(x, y, strict=True) if a != b}
    assert got == {(words[a], w) for a in longer for w in words if one_edit(words[a], w)}
    a, b = (m.ravel() for m in np.meshgrid(longer, all_))
    x, y, _ = spelling.pairs_of(left, right, a, b)
    assert got == {(words[i], words[j]) for i, j in zip(x, y, strict=True) if i != j}


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows, 31)
    assert len(want) > 500
    assert found(registry.QUERIES["op12_dense_tiling"](spark, folder)) == want
