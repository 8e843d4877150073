import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from finledger.llm import risk_rules, rule_ensemble, textstats

from .edge import TEXTS, collected, documents, labels, prose


def plain_statistics(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if any(c not in " \t\x0b\x0c\r" for c in x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_against_the_plain_ones():
    rng = random.Random(1)
    texts = [t or "" for _, t in TEXTS if not t or len(t) < 5000] + [
        "".join(rng.choice(["a ", "b ", "é\n", "a b c ", "\n", "##", "日 ", "\x1c", "\t"]) for _ in range(80))
        for _ in range(60)
    ]
    for text in texts:
        got = dict(zip(textstats.NAMES, textstats.statistics(text.encode()), strict=True))
        assert tuple(got[n] for n in BASE) == plain_statistics(text)


def test_many_kinds_of_words_take_the_other_way(monkeypatch):
    ids = np.array([1, 2, 3, 4, 1, 2, 3, 9, 9, 9, 9])
    assert textstats.repeated_words(ids, 10) == textstats.repeated_words(ids, 1 << 22) == 10


def corpus(n=600):
    """Good prose, and bad texts of two kinds; the labels say which."""
    docs, marks = [], []
    for i in range(n):
        kind = i % 6
        text = prose(i, 60 + i % 50)
        if kind == 0:
            text = " ".join(w + "!!" for w in text.upper().split())
        elif kind == 1:
            text = " ".join(["spam"] * 80)
        docs.append((i, text))
        marks.append((i, int(kind > 1), 0))
    return docs, marks


def test_classifier_on_held_out_rows_and_its_column(spark):
    docs, marks = corpus()
    settings = rule_ensemble.Settings(trees=15, sample=400)
    got = rule_ensemble.score_documents(documents(spark, docs), labels(spark, marks), settings=settings).collect()
    truth = {k: q for k, q, _ in marks}
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_labels_do_not_matter(spark):
    docs, marks = corpus(120)
    settings = rule_ensemble.Settings(trees=5)
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, t) for k, q, t in marks]
    both = [collected(rule_ensemble.score_documents(documents(spark, docs), labels(spark, m), settings=settings),
                      "doc_id", "score") for m in (marks, flipped)]
    assert both[0] == both[1]


def test_rules_and_their_expression_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(rule_ensemble.FEATURES)))
    y = ((x[:, 0] > 0) & (x[:, 3] < 0.5)).astype(float)
    model = rule_ensemble.fit(x, y, rule_ensemble.Settings(trees=10, leaf=10))
    assert 0 < len(model.rules) and ((model.score(x) > 0.5) == (y > 0)).mean() > 0.95
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(rule_ensemble.FEATURES))
    scores = [r[0] for r in df.select(model.column()).collect()]
    assert np.allclose(sorted(scores), sorted(model.score(x)), atol=1e-12)


def test_lasso_sets_weights_to_zero():
    rng = np.random.default_rng(2)
    r = (rng.random((800, 30)) > 0.5).astype(np.float32)
    y = (rng.random(800) < 1 / (1 + np.exp(-(3 * r[:, 0] - 2)))).astype(np.float32)
    _, few = rule_ensemble.lasso_logistic(r, y, 0.3, 300)
    assert few[0] > 0.5 and (few != 0).sum() <= 5


def test_classifier_edge_rows(spark):
    got = rule_ensemble.score_documents(documents(spark), labels(spark)).collect()
    assert len(got) == len(TEXTS) and {r.score for r in got} == {0.5}
    one = labels(spark, [(4, 1, None), (4, None, 0), (99, 0, 0), (None, 1, 0), (5, 7, 0)])
    assert len(rule_ensemble.score_documents(documents(spark), one).collect()) == len(TEXTS)
    assert rule_ensemble.score_documents(documents(spark, []), one).collect() == []
    kept = rule_ensemble.keep_good(documents(spark), one)
    assert kept.columns == documents(spark).columns and kept.count() == len(TEXTS)


def test_exact_tail():
    for n, k, rate in ((10, 0, 0.1), (30, 4, 0.2), (200, 1, 0.01)):
        want = sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
        assert abs(risk_rules.tail(n, k, rate) - want) < 1e-9
    assert risk_rules.tail(5, 5, 0.1) == 1


def test_cutoffs_stop_at_the_first_that_fails():
    ladder = risk_rules.LADDERS["symbols"][1]
    counts = {r: [0] * 7 for r in risk_rules.LADDERS} | {"symbols": [0, 0, 90, 0, 0, 0, 0]}
    found = risk_rules.certified(counts, 5000, 4, 0.05, 0.05)
    assert found["symbols"] == ladder[1]
    assert found["marks"] == risk_rules.LADDERS["marks"][1][-1]
    assert set(risk_rules.certified(counts, 50, 4, 0.05, 0.05).values()) == {None}
    n = risk_rules.least_rows(4, 0.05, 0.05)
    assert risk_rules.certified(counts, n, 4, 0.05, 0.05)["marks"] is not None
    assert risk_rules.certified(counts, n - 1, 4, 0.05, 0.05)["marks"] is None


def test_false_rejections_stay_below_the_limit():
    """Over many drawn holdouts the certified cutoffs break their limit in fewer cases than
    the error level allows."""
    rng = np.random.default_rng(5)
    share = risk_rules.LIMIT / len(risk_rules.LADDERS)
    true = np.array([0.5, 0.7, 0.9, 1.05, 1.3, 2.0, 3.0]) * share
    broken = 0
    for _ in range(300):
        counts = {r: rng.binomial(4000, true).tolist() for r in risk_rules.LADDERS}
        found = risk_rules.certified(counts, 4000, 1, risk_rules.LIMIT, risk_rules.ERROR)
        broken += any(
            c is not None and true[risk_rules.LADDERS[r][1].index(c)] > share for r, c in found.items()
        )
    assert broken <= 0.05 * 300


def test_verdicts_against_plain_python(spark):
    docs, marks = corpus(3000)
    rows = docs + TEXTS
    limit, error = 0.2, 0.2
    got = risk_rules.judge_documents(
        documents(spark, rows), labels(spark, [*marks, (4, 1, 0), (None, 1, 0)]), limit=limit, error=error
    ).collect()
    stats = {t: textstats.statistics((t or "").encode()) for _, t in rows}
    named = {t: dict(zip(textstats.NAMES, s, strict=True)) for t, s in stats.items()}

    def failed(t):
        s = named[t]
        return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]

    def ratio(t, name):
        s = named[t]
        words, chars, lines = (max(s[k], 1) for k in ("n_words", "word_chars", "n_lines"))
        return {"symbols_per_word": s["n_symbols"] / words, "marks_per_word": s["n_marks"] / words,
                "upper_share": s["n_upper"] / chars, "digit_share": s["n_digits"] / chars,
                "top_word_share": s["n_top_word"] / words, "dup_line_share": s["n_dup_lines"] / lines}[name]

    good = [t for (_, t), (_, q, _) in zip(docs, marks, strict=True) if q == 1 and not failed(t)]
    counts = {r: [sum(ratio(t, s) > c for t in good) for c in ladder]
              for r, (s, ladder) in risk_rules.LADDERS.items()}
    cut = risk_rules.certified(counts, len(good), 1, limit, error)
    assert any(c is not None for c in cut.values())
    want = []
    for k, t in rows:
        beyond = [r for r, (s, _) in risk_rules.LADDERS.items() if cut[r] is not None and ratio(t, s) > cut[r]]
        want.append((k, *(named[t][n] for n in BASE), failed(t), not failed(t) and not beyond))
    assert collected(
        spark.createDataFrame(got), "doc_id", *BASE, "base_failed", "kept"
    ) == sorted(want, key=repr)


def test_rules_edge_tables(spark):
    assert risk_rules.judge_documents(documents(spark, []), labels(spark)).collect() == []
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    got = risk_rules.judge_documents(docs, labels(spark)).collect()
    assert len(got) == len(TEXTS) and all(r.kept == (not r.base_failed) for r in got)
