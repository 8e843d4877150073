import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from finledger.llm import pii, pii_labels

from .edge import TEXTS, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


PARTS = st.sampled_from(list("a.b@c-+%_1 2(3)45 6.7\n") + [
    "x@y.zz", "10.2.3.4", "255.255.256.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "00.01.002.3", "日@a.b"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_patterns_are_leftmost_matches(text):
    assert pii.base_spans(text) == plain(text)


def test_long_texts_take_no_square_of_their_length():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "@" * 300_000):
        pii.base_spans(text)


def table(n=240):
    rng = random.Random(2)
    words = "river stone house green under over light old young day".split()
    out = []
    for i in range(n):
        item = [f"{rng.choice(words)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
                ".".join(str(rng.randrange(256)) for _ in range(4)),
                f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
                f"{rng.randrange(10**6):x}z{i}", f"{rng.randrange(3000)}"][i % 5]
        text = " ".join([*rng.choices(words, k=3), item, *rng.choices(words, k=3)])
        out += pii.labelled(text, pii.base_spans(text))
    return out


@pytest.fixture(scope="module")
def field():
    return pii.fit(table())


def test_field_finds_the_kinds_again_on_words_not_seen(field):
    rng = random.Random(77)
    hit = total = 0
    for i in range(60):
        item = [f"{rng.choice(['cloud', 'sand'])}.{rng.randrange(99)}@post3.sample.org", ".".join(str(rng.randrange(256)) for _ in range(4)),
                f"number {rng.randrange(3000)}"][i % 3]
        chain = next(pii.chains(f"stone river {item} house green"))
        tags = field.tags([chain.words])[0]
        want = [1, 2, 0][i % 3]
        total += 1
        hit += int(tags.max() == want)
    assert hit >= 0.9 * total


def test_viterbi_is_the_best_of_all_paths(field):
    rng = np.random.default_rng(1)
    model = pii.Field(field.names, rng.normal(size=field.emission.shape), rng.normal(size=field.transition.shape), 0.3)
    sequences = [["a", "10.0.0.1", "b"], ["x@y.zz"], ["+1", "(555)", "12", "of", "7"]]
    for words, got in zip(sequences, model.tags(sequences), strict=True):
        def score(path, words=words):
            total = 0.0
            for j, t in enumerate(path):
                rows = [model.names.get(f, len(model.names)) for f in pii.word_features(words, j)]
                total += model.emission[rows].sum(axis=0)[t] + (0.3 if t == 0 else 0)
                total += model.transition[path[j - 1], t] if j else 0
            return total
        best = max(itertools.product(range(len(pii.TAGS)), repeat=len(words)), key=score)
        assert tuple(got) == best


def test_added_spans_touch_no_base_span_and_prose_stays_clean(field):
    text = "stone 61.12.3.999 river 10.0.0.1, old a@b.example.com day"
    own, every = pii.find([text], field)[0]
    assert set(own) <= set(every)
    for a, b, _ in set(every) - set(own):
        assert all(b <= c or d <= a for c, d, _ in own)
    clean = ["plain words only here", "in 1999 there were 12 things", "chapter 3 of 4", ""]
    assert pii.find(clean, field) == [([], [])] * 4


def test_shapes_see_the_whole_word():
    url = "https://host.example/" + "a/B-7/" * 20
    words = [url + "1", url + "x", url + "x" * 50 + "12", url * 2]
    for cut in (pii.shape, pii.coarse):
        assert len({cut(w) for w in words}) == len(words)
        assert all(len(cut(w)) <= 64 for w in words)
    assert pii.shape("a" * 70 + "12345") == "xdddd" and pii.coarse("a" * 70 + "12") == "xd"


def test_chains_cover_every_marked_word():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice(["a", "b", "c", "d1", "@", "+"]) if rng.random() < 0.3 else "x" for _ in range(60)]
        text = "  ".join(words)
        got = [s for c in pii.chains(text) for s in c.spans]
        assert got == sorted(set(got))
        marked = {m.span() for m in pii.WORD.finditer(text) if pii.MARKED.search(m[0])}
        assert marked <= set(got)


@pytest.fixture(scope="module")
def given_field(spark):
    return pii.trained(spark)


def held_out(n=1500):
    """Sentences of another seed, as (text, [(begin, end, kind)] of whole words, signs cut)."""
    for i in range(n):
        text, wanted = "", []
        for piece, kind in pii_labels.sentence(i, 99):
            if text:
                text += " "
            if kind:
                wanted.append((len(text), len(text) + len(piece), kind))
            text += piece
        yield text, wanted


def test_added_spans_on_held_out_sentences(given_field):
    rows = list(held_out())
    found = pii.find([t for t, _ in rows], given_field)
    added = right = wanted = caught = 0
    for (text, want), (base, every) in zip(rows, found, strict=True):
        more = [s for s in every if s not in base]
        missed = [w for w in want if not any(a < w[1] and w[0] < b for a, b, _ in base)]
        added += len(more)
        right += sum(any(a >= w[0] and b <= w[1] and k == w[2] for w in missed) for a, b, k in more)
        wanted += len(missed)
        caught += sum(any(a >= w[0] and b <= w[1] and k == w[2] for a, b, k in more) for w in missed)
    print(f"added {added}, precision {right / added:.3f}, recall {caught / wanted:.3f}")
    assert added > 300 and right >= 0.95 * added and caught >= 0.75 * wanted


FORMS = [
    ("write to anna.berg (at) posthaus.org today", ["email"], "anna.berg (at) posthaus.org"),
    ("contact jo[at]north[dot]example.", ["email"], "jo[at]north[dot]example"),
    ("the host 10[.]20[.]3[.]44 answered", ["ip"], "10[.]20[.]3[.]44"),
    ("server 2001:db8:0:1:1:1:1:1 is down", ["ip"], "2001:db8:0:1:1:1:1:1"),
    ("card 4111.1111.1111.1111 was paid", ["card"], "4111.1111.1111.1111"),
    ("call (415) 555-0132 now", ["phone"], "(415) 555-0132"),
    ("phone 415-555-0132, please", ["phone"], "415-555-0132"),
    ('the token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" leaked', ["secret"], "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"),
]


@pytest.mark.parametrize("text, kinds, span", FORMS)
def test_forms_that_patterns_miss(given_field, text, kinds, span):
    base, every = pii.find([text], given_field)[0]
    assert base == [] and [(text[a:b], k) for a, b, k in every] == [(span, kinds[0])]
    assert pii.masked(text, every) == text.replace(span, f"[{kinds[0].upper()}]")


def test_numbers_that_look_alike_stay(given_field):
    clean = ["on 2024-05-17 at 12:30:45 in 1999", "version 1.2.3 and v10.4.12", "commit 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b",
             "the number 4529603461135147 is no card", "978-3-16-148410-9", "$1,299.00 or 15 %", "look (at) the river", "2 + 2 @ 3"]
    assert [every for _, every in pii.find(clean, given_field)] == [[]] * len(clean)


def test_adjacent_spans_are_told_apart(given_field):
    text = "call 415-555-0132 415-555-0199 or a@b.example.com jo (at) north.org"
    base, every = pii.find([text], given_field)[0]
    assert [k for _, _, k in base] == ["email"]
    assert [text[a:b] for a, b, _ in every] == ["415-555-0132", "415-555-0199", "a@b.example.com", "jo (at) north.org"]


def test_a_field_without_labels_adds_nothing(spark):
    empty = pii.train(spark.createDataFrame([], "words array<string>, tags array<bigint>"))
    assert all(base == every for base, every in pii.find([t for t, _, _ in FORMS], empty))


def test_the_field_adds_spans_to_given_documents(spark, given_field):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kinds = [s.split(":")[0] for r in pii.find_in_documents(docs, field=given_field).collect() for s in r.spans.split(",") if s]
    counts = {k: kinds.count(k) for k in set(kinds)}
    print(counts)
    assert counts.get("secret", 0) > 0


def test_documents_and_masks(spark, field):
    got = pii.find_in_documents(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = {k: t for k, t in TEXTS}[r.doc_id] or ""
        want = plain(text)
        assert r.base_sha256 == hashlib.sha256(pii.listed(want).encode()).hexdigest()
        counts = [sum(k == kind for _, _, k in want) for kind in pii.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert set(pii.listed(want).split(",")) - {""} <= set(r.spans.split(","))
    docs = documents(spark)
    masked = pii.mask_documents(docs, field=field)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[-3] == "mail [EMAIL] or [PHONE], [IP]; [CARD]"
    assert texts[1] is None and texts[2] == ""
    assert pii.find_in_documents(documents(spark, [])).collect() == []


def test_overlapping_spans_become_one():
    assert pii.masked("abcdefgh", [(1, 4, "ip"), (2, 6, "card"), (6, 7, "phone")]) == "a[IP][PHONE]h"


def test_chains_hold_every_word_marked_or_not():
    text = "stone river house green " * 5 + "pay to a@b.co " + "far away words " * 10 + "call +1 555 0100"
    words = [m.span() for m in pii.WORD.finditer(text)]
    assert [s for c in pii.chains(text) for s in c.spans] == words
    assert [c.words for c in pii.chains("password hunter two")] == [["password", "hunter", "two"]]
    assert list(pii.chains(" \t \n ")) == []


ODD = st.sampled_from(["stone", "River,", "123", "4.5", "(at)", "[dot]", "a@b.co", "+1", "(555)", "token", "=", "key:", "2001:db8::1", "É", "ǅx",
                       "Ⓐ", "²", "İstanbul", "^", "$", "...", "\xa0x", "٣٤", "deadbeefdeadbeef", "x=y", "a" * 70, "ß.", "10.0.0.1", "日本"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ODD | st.text("aZé9.,:@+-_[(=)]^$", min_size=1, max_size=20), max_size=9), min_size=1, max_size=4),
       st.integers(0, 2**32 - 1), st.sampled_from([0.1, 1.0, 3.0]))
def test_words_said_once_score_and_decode_as_their_features(given_field, sequences, seed, spread):
    rng = np.random.default_rng(seed)
    emission = given_field.emission if seed % 2 else rng.normal(size=given_field.emission.shape)
    emission[-1] = 0
    model = pii.Field(given_field.names, emission, rng.normal(size=given_field.transition.shape) * spread, 0.5)
    ids, inside = model.lexicon.line(sequences)
    got, at = model.lexicon.scores(ids, inside), 0
    for words, path in zip(sequences, model.tags(sequences), strict=True):
        assert len(path) == len(words)
        if not words:
            continue
        rows = [[model.names.get(f, len(model.names)) for f in pii.word_features(words, j)] for j in range(len(words))]
        score = emission[np.array(rows)].sum(axis=1)
        assert (got[at:at + len(words)] == score).all()
        at += len(words)
        score[:, 0] += 0.5
        best, back = score[:1], []
        for s in score[1:]:
            step = best[0][:, None] + model.transition
            back.append(step.argmax(axis=0))
            best = (step.max(axis=0) + s)[None]
        want = [int(best[0].argmax())]
        for b in reversed(back):
            want.insert(0, int(b[want[0]]))
        assert path.tolist() == want


def test_a_long_text_costs_what_its_distinct_words_do(given_field, monkeypatch):
    rng, asked = random.Random(5), []
    names = [f"{a}{b}" for a in "abcde" for b in ("ra", "4", "lo,", "@x.y", "(at)")]
    text = " ".join(rng.choices(names, k=5000))
    monkeypatch.setattr(pii, "parts_of", lambda word, f=pii.parts_of: asked.append(word) or f(word))
    pii.find([text, text], pii.Field(given_field.names, given_field.emission, given_field.transition, 0.5))
    assert len(asked) <= 10 * len(names)
