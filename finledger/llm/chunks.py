"""Cutting texts where a byte-pair tokenizer cuts anyway, and remembering what chunks become.

Natural text repeats its words, so a worker keeps the ids of the chunks it has seen (bounded:
the memory is emptied when it is full) and a tokenizer only sees new chunks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import filterfalse

import numpy as np

# What the tokenizers' patterns call white space (the Unicode property).
SPACE = "\t-\r \x85\xa0  -     　"
RUNS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
ENDS_IN_SPACE = re.compile(f"[{SPACE}]\\Z")
MEMORY = 500_000  # chunks of a generation; a worker keeps two, some 200 MB


def spaced_chunks(text: bytes) -> list[bytes] | None:
    """The text cut in front of every blank; joined they are the text.

    These are token boundaries as long as each chunk but the last ends in something else
    than white space; the caller's memory tells (``UNSAFE``).
    """
    return text.replace(b" ", b"\xff ").split(b"\xff")


def run_chunks(text: bytes) -> list[bytes]:
    """White space and the word behind it, for any text: a match of the patterns that starts in
    front of white space depends on nothing before it, and none goes on from a word into white
    space."""
    return [c.encode() for c in RUNS.findall(text.decode())]


# Last bytes of chunks that end in an ASCII character and not in white space.
PLAIN_ENDS = frozenset(range(128)) - frozenset(b"\t\n\x0b\x0c\r ")


def safe(chunk: bytes) -> bool:
    return not chunk or (chunk != b" " and not ENDS_IN_SPACE.search(chunk[-3:].decode(errors="ignore")))


def places_of_none(values: list) -> list[int]:
    out: list[int] = []
    at = -1
    try:
        while True:
            at = values.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


class Memory(dict):
    """Chunk (text or bytes) to packed ids (little-endian, 4 bytes each), filled from ``encode`` in bulk.

    When it is full it becomes the old generation, from which chunks that occur again come back.
    """

    def __init__(self, encode: Callable[[list[bytes]], Iterable[bytes]], limit: int = MEMORY):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def _make_room(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def learn(self, lists: list[list[bytes]]) -> None:
        """Makes sure that all these chunks are known."""
        self._make_room()
        missing: set[bytes] = set()
        for chunks in lists:
            missing.update(filterfalse(self.__contains__, chunks))
        self._add(missing)

    def _add(self, missing: set[bytes]) -> None:
        if missing and self.old:
            known = missing & self.old.keys()
            self.update(zip(known, map(self.old.__getitem__, known), strict=True))
            missing -= known
        if missing:
            new = list(missing)
            self.update(zip(new, self.encode(new), strict=True))

    def packed(self, lists: list[list[bytes]]) -> list[bytes]:
        """The ids of each list of chunks; every chunk is looked up once, new ones twice. A chunk
        that is remembered as None is an error."""
        self._make_room()
        found = [list(map(self.get, chunks)) for chunks in lists]
        gaps = [places_of_none(ids) for ids in found]
        missing = {chunks[i] for chunks, places in zip(lists, gaps, strict=True) for i in places}
        self._add({c for c in missing if c not in self})
        for ids, chunks, places in zip(found, lists, gaps, strict=True):
            for i in places:
                ids[i] = self[chunks[i]]
        return [b"".join(ids) for ids in found]


def slices(sizes: Iterable[int], most: int) -> Iterable[tuple[int, int]]:
    """Neighbouring rows gathered up to about ``most`` bytes."""
    begin = total = at = 0
    for at, size in enumerate(sizes):
        if at > begin and total + size > most:
            yield begin, at
            begin, total = at, 0
        total += size
    if total or begin <= at:
        yield begin, at + 1


def ids_array(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")
