import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from finledger.llm import prefix_bpe as bpe
from finledger.llm.chunks import Memory, ids_array
from finledger.llm.library_bpe import Library

from .edge import TEXTS, collected, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return bpe.PrefixEncoder(bpe.read_ranks(RANKS), PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )


PARTS = st.sampled_from(
    list("aabcE  \n\t'sté12!.-,;\xa0　\x1c\x85\x01Σς½²ßİ")
    + ["the ", "ing", " und", "日本", "\U0001F600", "<|endoftext|>", "!!", "  ", "é", "क़"]
)
SOME_TEXT = st.lists(PARTS, max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(SOME_TEXT)
def test_same_ids_as_the_reference_and_back(own, reference, text):
    packed = own.encode([text.encode()])[0]
    assert ids_array(packed).tolist() == reference.encode_ordinary(text)
    assert own.decode(packed) == text.encode()


@settings(max_examples=150, deadline=None)
@given(SOME_TEXT, SOME_TEXT, st.data())
def test_edits_are_exact(own, reference, text, new, data):
    state = bpe.EditableText(own, text)
    state.append(new)
    text += new
    assert state.ids() == reference.encode_ordinary(text)
    begin = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(begin, min(len(text), begin + 4)))
    state.replace(begin, end, new)
    text = text[:begin] + new + text[end:]
    assert state.text() == text and state.ids() == reference.encode_ordinary(text)


def test_an_edit_of_a_long_piece_recomputes_only_near_it(own):
    piece = b"abcdefghij" * 1000
    state = bpe.EditablePiece(own, piece)
    computed = state.replace(5000, 5003, b"zz")
    piece = piece[:5000] + b"zz" + piece[5003:]
    assert computed < 500 and state.ids() == own.walk_back(piece, own.states(piece))


def test_very_long_single_piece(own, reference):
    for text in ("a" * 20_000, "-" * 20_000, " " * 20_000):
        assert ids_array(own.encode([text.encode()])[0]).tolist() == reference.encode_ordinary(text)


def test_documents(spark, reference):
    got = bpe.encode_documents(documents(spark), RANKS, PATTERN, digests=True)
    want = []
    for key, text in TEXTS:
        ids = reference.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((key, len(ids), hashlib.sha256(packed).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert collected(got, *columns) == sorted(want, key=repr)
    whole = bpe.encode_documents(documents(spark), RANKS, PATTERN)
    assert all(bytes(r.decoded) == (dict(TEXTS)[4]).encode() for r in whole.collect() if r.doc_id == 4)
    assert bpe.encode_documents(documents(spark, []), RANKS, PATTERN).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_ids_by_chunks_are_those_of_whole_texts(name):
    path = public_tokenizers.path(name)
    library, whole = Library(path), Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng = random.Random(5)
    parts = list("aabcE  \n\t'sté12!.-,;\xa0　\x1c\x85\x01Σς½²ßİ") + [
        "the ", "ing", " und", "日本", "<|endoftext|>", "!!", "  ", "é", "क़"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(4000)]
    for a in range(0, len(texts), 200):
        got = library.encode([t.encode() for t in texts[a:a + 200]])
        want = whole.encode_batch(texts[a:a + 200], add_special_tokens=False)
        assert [g.tolist() for g in got] == [w.ids for w in want]


def test_memory_is_bounded_and_gives_the_same():
    asked = []

    def encode(chunks):
        asked.extend(chunks)
        return [c * 2 for c in chunks]

    memory = Memory(encode, limit=3)
    lists = [[b"%d" % (i % 7) for i in range(k, k + 4)] for k in range(40)]
    for one in lists:
        assert memory.packed([one]) == [b"".join(c * 2 for c in one)]
        assert len(memory) <= 3 + 4
    assert len(asked) < 160


def test_texts_of_both_kinds_with_a_full_memory(own, reference):
    library = Library(public_tokenizers.path("byte_bpe_50k.json"))
    limited = bpe.PrefixEncoder(own.ranks, PATTERN)
    limited.memory = Memory(limited._encode_chunks, limit=3)
    library.memory = Memory(library._spaced, limit=3)
    texts = ["one two three four five", "ends in a line\n", "six seven", "two  blanks", "eight \nnine",
             "one two", "ends in a line\n"]
    for _ in range(3):
        want = [reference.encode_ordinary(t) for t in texts]
        given = [t.encode() for t in texts]
        assert [ids_array(p).tolist() for p in limited.encode(given)] == want
        whole = [library.ids(t) for t in texts]
        assert [i.tolist() for i in library.encode(given)] == whole
        texts = texts[::-1] + ["more words than before", "and a tail\n"]
