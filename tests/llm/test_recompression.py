import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finledger.llm import recompression as rc

from .edge import TEXTS, collected, documents, prose


def brute(rows):
    """Windows compared word by word; null ids are one id before all others."""
    ids = [rc.NULL_KEY if k is None else k for k, _ in rows]
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for k, w in zip(ids, words, strict=True):
        for s in range(len(w) - 19):
            name = tuple(w[s:s + 20])
            first[name] = min(first.get(name, (k, s)), (k, s))
    out = []
    for (key, _), k, w in zip(rows, ids, words, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (k, s):
                gone[s:s + 20] = [True] * 20
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("alphabet", [1, 2, 3, 40])
def test_equal_windows_share_key_and_name(alphabet):
    rng = random.Random(alphabet)

    def some(n):
        return [b"w%d" % rng.randrange(alphabet) for _ in range(n)]

    shared = [some(rng.randrange(15, 70)) for _ in range(10)]
    docs = [some(rng.randrange(30)) + rng.choice(shared) + some(rng.randrange(30)) for _ in range(150)]
    docs += [[], some(19), some(20)]
    stretch = rc.Stretch([b" ".join(d) for d in docs])
    at, keys = stretch.keys()
    names = stretch.window_names(at)
    flat = [w for d in docs for w in d]
    assert len(at) == sum(max(0, len(d) - 19) for d in docs)
    seen = {}
    for p, key, name in zip(at.tolist(), keys.tolist(), names.tolist(), strict=True):
        assert seen.setdefault(tuple(flat[p:p + 20]), (key, name)) == (key, name)
    assert len({name for _, name in seen.values()}) == len(seen)


def test_words_are_cut_and_named_by_their_bytes():
    texts = [b"", b"  a bb\n\na", b"\xc3\xa9 a", b" \t\r", b"bb", b"x" * 3_000_000 + b" a " + b"y" * 5]
    stretch = rc.Stretch(texts)
    words = [w for t in texts for w in t.split()]
    assert stretch.sizes.tolist() == [len(t.split()) for t in texts]
    names = stretch.names.tolist()
    assert all((names[i] == names[j]) == (words[i] == words[j])
               for i in range(len(words)) for j in range(len(words)))


def test_few_keys_per_word():
    stretch = rc.Stretch([prose(1, 5000).encode()])
    _, keys = stretch.keys()
    assert len(np.unique(keys)) < 0.25 * 5000


@pytest.mark.parametrize("hot", [10_000, 1])
def test_against_brute_force(spark, hot):
    rng = random.Random(9)
    shared = [prose(100 + i, n) for i, n in enumerate((19, 20, 21, 25, 40, 90))]
    rows = list(TEXTS)
    for i in range(120):
        parts = [prose(1000 + i * 7 + j, rng.randrange(0, 25)) for j in range(3)]
        rows.append((100 + i, " ".join([parts[0], rng.choice(shared), parts[1], rng.choice(shared), parts[2]])))
    rows += [(300, "a " * 70), (301, "a " * 30 + "b " * 30), (302, "x y " * 40), (303, "y x " * 40)]
    got = rc.remove_repeats(documents(spark, rows), hot=hot)
    assert collected(got, *COLUMNS) == brute(rows)


def one_id_many_texts():
    """Rows of one id, null ids among them, with different long texts, and copies under one id."""
    shared = [prose(500 + i, 45) for i in range(4)]
    rows = [(3, shared[0]), (4, f"{prose(510, 9)} {shared[1]} {prose(511, 30)}")]
    for key in (7, 8, None):
        rows += [(key, prose(520 + (key or 0), 200)), (key, f"{shared[0]} {prose(530 + (key or 0), 60)}"),
                 (key, f"{prose(540 + (key or 0), 60)} {shared[1]} {shared[0]}"), (key, shared[2]),
                 (key, f"{prose(550, 12)} {shared[2]} {shared[3]}")]
    return rows + [(9, shared[0])] * 5 + [(None, f"{shared[3]} end")] * 4


@pytest.mark.parametrize("hot", [10_000, 1])
def test_rows_of_one_id_lose_their_own_words_only(spark, hot):
    rows = one_id_many_texts()
    docs = documents(spark, rows)
    want = brute(rows)
    assert collected(rc.remove_repeats(docs, hot=hot), *COLUMNS) == want
    kept = sorted((r.doc_id is None, r.doc_id or 0, hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest())
                  for r in rc.cut_documents(docs, hot=hot).collect())
    assert kept == sorted((k is None, k or 0, digest) for k, _, _, digest in want)


def test_copies_under_one_id_count_once(spark):
    rows = one_id_many_texts()
    found = rc.earlier_windows(rc._rows(documents(spark, rows), "doc_id", "text"))
    parts = {(r.doc, r["sum"]): r.starts for r in found.collect()}
    assert all(len({tuple(p) for p in lists}) == len(lists) for lists in parts.values())


def test_empty_table(spark):
    assert rc.remove_repeats(documents(spark, [])).collect() == []


def test_cut_documents_keeps_the_rest_of_the_text(spark):
    passage = prose(5, 40)
    rows = [(1, f"one\n\n  {passage}  end"), (2, f"two\t{passage}\n\nrest  here"), (3, passage), (4, None), (5, "")]
    docs = documents(spark, rows)
    cut = rc.cut_documents(docs)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == rows[0][1] and texts[2].split() == ["two", "rest", "here"]
    assert texts[2].endswith("rest  here")
    assert texts[3].split() == [] and texts[4] is None and texts[5] == ""
    words = rc.remove_repeats(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    kept = {r.doc_id: r.kept_sha256 for r in words.collect()}
    assert all(hashlib.sha256(" ".join((t or "").split()).encode()).hexdigest() == kept[k]
               for k, t in texts.items())


def test_words_that_powers_of_a_base_confuse(spark):
    """A Thue-Morse word of two letters and its complement are two words."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{word} {tail}"), (2, f"{other} {tail}"), (3, f"{word} {tail}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_removed"] for r in rc.remove_repeats(df).collect()}
    assert got == {1: 0, 2: 0, 3: 20}


def test_cutting_keeps_columns_with_dots(spark):
    rows = [(1, "x " * 30, 5), (2, "x " * 30, 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` int")
    assert rc.cut_documents(df).columns == df.columns
    assert sorted(r["a.b"] for r in rc.cut_documents(df).collect()) == [5, 6]
