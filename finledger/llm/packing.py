"""Cost-balanced packing of documents into sequences.

A sequence costs its tokens (linear layers) plus the squares of its pieces' lengths
(attention inside a piece). Pieces are taken in descending length; each goes to the sequence
of lowest cost that still has room for it. A piece for which no sequence has room is cut: the
cheapest sequence that is not full takes what fits, the rest goes on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from finledger.llm.chunks import slices
from finledger.llm.common import batches, texts_of
from finledger.llm.library_bpe import library_of

CAPACITY = 4096
END_ID = 2
# Documents are packed together up to so many tokens: a thousand sequences leave the balance
# nothing to wish for, and the ids take 16 MB.
POOL_TOKENS = 4 << 20
BATCH_BYTES = 4 << 20
# Cost of a token, and of a token attending to another one of its piece, in the same unit: at a
# model width of some thousand both halves meet at some thousand tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096

PIECES = pa.schema([
    ("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
])


def sequence_sizes(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, and for the rest one sequence for each power of two in it, longest
    first: a batch has shapes of powers of two only, and no padding at all."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [
        1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1
    ]


def balance(
    lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for documents of these lengths.

    Whole sequences are cut off a document longer than one first, at its front. Ties go to
    the earlier document and the earlier sequence.
    """
    placed, open_docs, sequence = [], [], 0
    for doc, tokens in enumerate(lengths.tolist()):
        whole = tokens // capacity * capacity
        for start in range(0, whole, capacity):
            placed.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if tokens > whole:
            open_docs.append((doc, whole, tokens - whole))
    sizes = np.array(sequence_sizes(sum(d[2] for d in open_docs), capacity), dtype=np.int64)
    used, cost = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
    for doc, start, tokens in sorted(open_docs, key=lambda d: -d[2]):
        while tokens:
            room = sizes - used
            fits = room >= tokens
            if not fits.any():
                fits = room > 0
            at = int(np.argmin(np.where(fits, cost, np.inf)))
            take = int(min(tokens, room[at]))
            placed.append((doc, start, take, sequence + at, int(used[at])))
            used[at] += take
            cost[at] += linear * take + quadratic * take * take
            start, tokens = start + take, tokens - take
    return placed


def _pools(
    rows: Iterable[pa.RecordBatch], tokenizer: str, end_id: int, pool_tokens: int
) -> Iterator[tuple[list, list[np.ndarray]]]:
    keys, ids, total = [], [], 0
    for batch in rows:
        names, texts = batch.column(0).to_pylist(), texts_of(batch, "text")
        for a, b in slices(map(len, texts), BATCH_BYTES) if texts else ():
            for key, own in zip(names[a:b], library_of(tokenizer).encode(texts[a:b]), strict=True):
                own = np.append(own, np.uint32(end_id)).astype("<u4")
                keys.append(key)
                ids.append(own)
                total += len(own)
                if total >= pool_tokens:
                    yield keys, ids
                    keys, ids, total = [], [], 0
    if keys:
        yield keys, ids


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, pool_tokens: int = POOL_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it comes from, its ids, and where it lies.

    Columns: the key, start, length, ids (little-endian 4 bytes each, left out without
    ``with_ids``), ids_crc32, doc_tokens, sequence_id, offset. Every id of a document, its end id
    included, lies in exactly one piece. Sequences hold ``capacity`` (a power of two) or, for the rest of a
    pool, a smaller power of two tokens, so nothing is padded. A null or empty text is its end id;
    equal rows are documents of their own; an empty table gives no rows; other columns are
    not read.

    A pool is what one task has gathered of its partition (``pool_tokens``), so there is no
    shuffle, and sequence ids (partition, number in it) need no common counter.
    """
    schema = PIECES if with_ids else PIECES.remove(PIECES.get_field_index("ids"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for keys, ids in _pools(rows, tokenizer, end_id, pool_tokens):
            placed = balance(np.array([len(i) for i in ids], dtype=np.int64), capacity)
            for a in range(0, len(placed), 8192):
                part = placed[a:a + 8192]
                cut = [ids[d][s:s + n].tobytes() for d, s, n, _, _ in part]
                yield from batches([{
                    "key": [keys[p[0]] for p in part], "start": [p[1] for p in part],
                    "length": [p[2] for p in part], "ids": cut,
                    "ids_crc32": [zlib.crc32(c) for c in cut],
                    "doc_tokens": [len(ids[p[0]]) for p in part],
                    "sequence_id": [first + p[3] for p in part], "offset": [p[4] for p in part],
                }], schema)
            first += max(p[3] for p in placed) + 1

    kinds = ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'long'}" for f in schema)
    rows = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
    return rows.mapInArrow(run, kinds).withColumnRenamed("key", key)
