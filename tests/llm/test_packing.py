import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from finledger.llm.packing import balance, pack_documents, sequence_sizes

from .edge import TEXTS, documents

WORDS = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60))
def test_every_token_lies_once_and_nothing_is_padded(lengths):
    placed = balance(np.array(lengths, dtype=np.int64), 64)
    tokens, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in placed:
        assert length > 0
        tokens[doc] += range(start, start + length)
        sequences[sequence] += range(offset, offset + length)
    assert {d: sorted(t) for d, t in tokens.items()} == {
        d: list(range(n)) for d, n in enumerate(lengths)
    }
    for held in sequences.values():
        assert sorted(held) == list(range(len(held)))
        assert len(held) <= 64 and len(held) & (len(held) - 1) == 0


def test_descending_pieces_go_to_the_cheapest_sequence():
    placed = balance(np.array([30, 40, 20, 38]), 64, linear=1, quadratic=1)
    assert sequence_sizes(128, 64) == [64, 64]
    # 40 and 38 open the sequences, 30 fits into neither and is cut at the cheaper one
    assert placed[:2] == [(1, 0, 40, 0, 0), (3, 0, 38, 1, 0)]
    assert placed[2][:4] == (0, 0, 26, 1)


def test_documents(spark):
    whole = Tokenizer.from_file(WORDS)
    want = sorted(
        whole.encode(t or "", add_special_tokens=False).ids + [2] for _, t in TEXTS
    )
    got = pack_documents(documents(spark), WORDS, pool_tokens=3000).collect()
    rebuilt = defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        rebuilt[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    single = {k: t for k, t in TEXTS if k not in (5, None)}
    for key, text in single.items():
        ids = [i for _, part, _ in sorted(rebuilt[key]) for i in part]
        assert ids == whole.encode(text or "", add_special_tokens=False).ids + [2]
        assert {n for _, _, n in rebuilt[key]} == {len(ids)}
    assert sum(r.length for r in got) == sum(map(len, want))
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    assert pack_documents(documents(spark, []), WORDS).collect() == []
