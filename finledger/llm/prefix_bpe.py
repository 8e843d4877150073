"""Byte-pair encoding by dynamic programming over prefixes.

Every byte prefix of a piece has exactly one encoding, so it has exactly one valid last token.
A token that ends the prefix is that one if what stands before it is a prefix whose own last
token *agrees* with it: the two, joined and merged from bytes, come out as the same two tokens.
Storing the last token of each prefix gives the encoding by walking back, lets bytes be
appended exactly, and after an edit recomputes only until the states meet the old ones.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from finledger.llm.chunks import Memory, ids_array, run_chunks, safe, slices, spaced_chunks
from finledger.llm.common import batches, texts_of

BATCH_BYTES = 4 << 20
PAIR_MEMORY = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pack(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype="<u4").tobytes()


class PrefixEncoder:
    """Encoder and decoder of one vocabulary of ranks (all 256 single bytes included)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.longest = max(map(len, ranks))
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            for n in {min(len(token), 2), min(len(token), 3)}:
                ends.setdefault(token[-n:], set()).add(len(token))
        # by the last bytes of a prefix: how long a token there can be, longest first
        short = {end: {n for n in sizes if n > 1} for end, sizes in ends.items()}
        self.lengths = {
            end: sorted(sizes | short.get(end[-2:], set()) & {2}, reverse=True)
            for end, sizes in short.items()
        }
        self.whole: dict[bytes, bool] = {}
        self.agreeing: dict[tuple[int, int], bool] = {}
        self.memory = Memory(self._encode_chunks)

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost on ties; for a pair of tokens only."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = len(self.ranks)
        while len(parts) > 1:
            joined = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(joined)
            if best == none:
                break
            at = joined.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def agrees(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.agreeing.get(key)
        if known is None:
            if len(self.agreeing) >= PAIR_MEMORY:
                self.agreeing.clear()
            known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.agreeing[key] = known
        return known

    def reachable(self, token: bytes) -> bool:
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.merged(token) == [self.ranks[token]]
        return known

    def last_token(self, piece: bytes, end: int, last: list[int]) -> int:
        """The valid last token of ``piece[:end]``; ``last[i]`` is that of ``piece[:i]``."""
        known = self.lengths
        sizes = known.get(piece[end - 3:end]) if end > 2 else None
        if sizes is None:
            sizes = known.get(piece[end - 2:end], ()) if end > 1 else ()
        ranks, agreeing = self.ranks, self.agreeing
        for size in sizes:
            if size > end:
                continue
            token = ranks.get(piece[end - size:end])
            if token is None:
                continue
            if size == end:
                if self.reachable(piece[:end]):
                    return token
                continue
            pair = (last[end - size], token)
            if agreeing[pair] if pair in agreeing else self.agrees(*pair):
                return token
        return ranks[piece[end - 1:end]]

    def states(self, piece: bytes) -> list[int]:
        last = [-1]
        for end in range(1, len(piece) + 1):
            last.append(self.last_token(piece, end, last))
        return last

    def walk_back(self, piece: bytes, last: list[int]) -> list[int]:
        """The ids of the piece. A piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids, end = [], len(piece)
        while end:
            ids.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.walk_back(piece, self.states(piece))

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes | None]:
        """Packed ids of each chunk, None for one that ends in white space.

        The pieces of all chunks are encoded once, in sorted order: neighbours share their first
        bytes, and so the stored last tokens of those prefixes.
        """
        cut = [[p.encode() for p in self.split(c.decode())] if safe(c) else None for c in chunks]
        packed: dict[bytes, bytes] = {}
        before, last = b"", [-1]
        for piece in sorted({p for pieces in cut if pieces for p in pieces}):
            if piece in self.ranks:
                packed[piece] = self.ranks[piece].to_bytes(4, "little")
                continue
            same = 0
            for a, b in zip(before, piece, strict=False):
                if a != b:
                    break
                same += 1
            last = last[:same + 1]
            for end in range(same + 1, len(piece) + 1):
                last.append(self.last_token(piece, end, last))
            before = piece
            packed[piece] = pack(self.walk_back(piece, last))
        return [None if c is None else b"".join([packed[p] for p in c]) for c in cut]

    def encode_runs(self, chunk: bytes) -> bytes:
        return pack(i for p in self.split(chunk.decode()) for i in self.encode_piece(p.encode()))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of whole texts."""
        lists = [spaced_chunks(t) for t in texts]
        try:
            return self.memory.packed(lists)
        except TypeError:  # a chunk ends in white space: cut that text at runs of white space
            pass
        get, out = self.memory.__getitem__, []  # all chunks are known; nothing below learns any
        for text, chunks in zip(texts, lists, strict=True):
            ids = list(map(get, chunks))
            if None in ids:
                ids = [self.encode_runs(c) for c in run_chunks(text)]
            out.append(b"".join(ids))
        return out

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids_array(packed).tolist()))


class EditablePiece:
    """A piece with the states of its prefixes: bytes are appended or replaced exactly."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.last = encoder, piece, encoder.states(piece)

    def append(self, more: bytes) -> None:
        begin = len(self.piece)
        self.piece += more
        for end in range(begin + 1, len(self.piece) + 1):
            self.last.append(self.encoder.last_token(self.piece, end, self.last))

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of ``piece[begin:end]``; returns how many states were computed.

        States before the edit stay. Behind it they are computed until as many in a row as
        the longest token has bytes equal the old ones: from there nothing can differ.
        """
        old_last, shift = self.last, len(new) - (end - begin)
        self.piece = self.piece[:begin] + new + self.piece[end:]
        self.last = old_last[:begin + 1]
        same = computed = 0
        for at in range(begin + 1, len(self.piece) + 1):
            token = self.encoder.last_token(self.piece, at, self.last)
            self.last.append(token)
            computed += 1
            behind = at - begin - len(new)
            same = same + 1 if behind > 0 and token == old_last[at - shift] else 0
            if same >= self.encoder.longest and behind > 2 * self.encoder.longest:
                self.last += old_last[at - shift + 1:]
                break
        return computed

    def ids(self) -> list[int]:
        return self.encoder.walk_back(self.piece, self.last)


class EditableText:
    """A text cut into pieces by the pattern; edits re-encode the pieces near them only."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder = encoder
        self.pieces = [EditablePiece(encoder, p.encode()) for p in encoder.split(text)]

    def text(self) -> str:
        return "".join(p.piece.decode() for p in self.pieces)

    def append(self, more: str) -> None:
        """Only the last piece can grow or break: no match looks behind its start, and an
        earlier match was ended by characters that are still there."""
        tail = self.pieces.pop().piece.decode() if self.pieces else ""
        begin = self.encoder.split(tail + more)
        if begin and begin[0].startswith(tail) and tail:
            grown = EditablePiece(self.encoder, tail.encode())
            grown.append(begin[0][len(tail):].encode())
            self.pieces.append(grown)
            begin = begin[1:]
        self.pieces += [EditablePiece(self.encoder, p.encode()) for p in begin]

    def replace(self, begin: int, end: int, new: str) -> int:
        """Replaces characters; returns how many pieces were encoded anew.

        Starts at the piece in front of the edit (its match may reach further now) and stops
        where the new cut meets an old one behind the edit.
        """
        sizes = [len(p.piece.decode()) for p in self.pieces]
        starts = [sum(sizes[:i]) for i in range(len(sizes) + 1)]
        first = max(0, next((i for i, s in enumerate(starts) if s + 1 > begin), len(sizes)) - 1)
        first = max(0, first - 1)
        rest = self.text()
        rest, shift = rest[:begin] + new + rest[end:], len(new) - (end - begin)
        old = {s + shift: i for i, s in enumerate(starts) if s >= end}
        fresh, at = [], starts[first]
        for piece in self.encoder.split(rest[at:]):
            if at in old and at >= begin + len(new):
                break
            fresh.append(EditablePiece(self.encoder, piece.encode()))
            at += len(piece)
        keep = old.get(at, len(self.pieces))
        self.pieces = self.pieces[:first] + fresh + self.pieces[keep:]
        return len(fresh)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p.ids()]


@functools.lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> PrefixEncoder:
    """One encoder per worker process and vocabulary."""
    return PrefixEncoder(read_ranks(path), pattern)


CODED = pa.schema([
    ("key", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary()),
])
DIGESTS = pa.schema([
    ("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
    ("decoded_sha256", pa.string()),
])


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
    digests: bool = False,
) -> DataFrame:
    """Every whole text's ids and the bytes they decode to.

    Columns: the key, n_tokens, ids (little-endian 4 bytes each) and decoded; with ``digests``
    their sha256 instead. A null or empty text has no ids; equal rows give equal rows; an empty
    table gives no rows; other columns are not read. No shuffle: rows stay in their partition.
    """
    schema = DIGESTS if digests else CODED

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks_path, pattern)
        for batch in rows:
            keys, texts = batch.column(0).to_pylist(), texts_of(batch, "text")
            for a, b in slices(map(len, texts), BATCH_BYTES) if texts else ():
                packed = encoder.encode(texts[a:b])
                plain = [encoder.decode(p) for p in packed]
                columns = {"key": keys[a:b], "n_tokens": [len(p) // 4 for p in packed]}
                if digests:
                    columns["ids_sha256"] = [hashlib.sha256(p).hexdigest() for p in packed]
                    columns["decoded_sha256"] = [hashlib.sha256(p).hexdigest() for p in plain]
                else:
                    columns |= {"ids": packed, "decoded": plain}
                yield from batches([columns], schema)

    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary"
    rows = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
    return rows.mapInArrow(run, f"key long, n_tokens long, {kinds}").withColumnRenamed("key", key)
