"""Ids of whole texts by the tokenizers library, with a memory of chunks seen before.

New chunks are handed to the library joined into long texts, which costs it far less than a
call for each, and its ids are cut back into chunks: by the bytes that ids stand for, or at a
separator word where the tokenizer drops white space.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata

import numpy as np

from finledger.llm.chunks import (
    PLAIN_ENDS,
    Memory,
    ids_array,
    run_chunks,
    safe,
    spaced_chunks,
)

JOIN = 20_000  # chunks handed over at once
SEPARATOR = "\x01"
# Letters that stay one letter when they are composed and lowered, and marks that are a token of
# their own behind such a letter (an apostrophe is not, as it may begin a contraction).
LETTERS = "".join(
    c for c in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x250)])
    if c.isalpha() and unicodedata.normalize("NFC", c).lower()[-1].isalpha()
)
# A line: letters and the marks behind them, or anything else.
MARKED_WORD = re.compile(
    f"^([{LETTERS}]+)([!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{{|}}~]*)$|^(.*)$", re.MULTILINE
)


class Library:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.spaced = self.ids(" ") != []
        self.memory = Memory(self._spaced if self.spaced else self._words)
        self.letters, self.marks = Memory(self._letters), Memory(self._separated)
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        if not self.spaced:
            ends = [i for word, i in words.items() if word.endswith("</w>")]
            self.is_end = np.zeros(max(words.values()) + 1, dtype=bool)
            self.is_end[ends] = True
        else:
            self.length = np.zeros(max(words.values()) + 1, dtype=np.int64)
            for word, i in words.items():
                self.length[i] = len(word)  # one character stands for one byte

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _one(self, chunk: bytes | str) -> bytes:
        text = chunk if isinstance(chunk, str) else chunk.decode()
        return np.array(self.ids(text), dtype="<u4").tobytes()

    def _spaced(self, chunks: list[bytes]) -> list[bytes | None]:
        """For tokenizers that keep every byte: chunks that begin with a blank are joined."""
        out: list[bytes | None] = [None] * len(chunks)
        plain = [c[:1] == b" " and c[-1] in PLAIN_ENDS for c in chunks]
        joined = [i for i, ok in enumerate(plain) if ok]
        for i, ok in enumerate(plain):
            if not ok and safe(chunks[i]):
                if chunks[i][:1] == b" ":
                    joined.append(i)
                else:
                    out[i] = self._one(chunks[i])
        for a in range(0, len(joined), JOIN):
            part = joined[a:a + JOIN]
            ids = np.array(self.ids(b"".join([chunks[i] for i in part]).decode()), dtype="<u4")
            ends = np.cumsum(self.length[ids])
            wanted = np.cumsum([len(chunks[i]) for i in part])
            at = np.searchsorted(ends, wanted)
            if not np.array_equal(ends[at], wanted):
                raise ValueError("a token reaches over a blank: not a tokenizer of this kind")
            packed, begin = ids.tobytes(), 0
            for i, end in zip(part, (4 * (at + 1)).tolist(), strict=True):
                out[i] = packed[begin:end]
                begin = end
        return out

    def _words(self, chunks: list[bytes]) -> list[bytes]:
        """For tokenizers that drop white space and mark the ends of words. A word of letters is
        one word for them, and so are the marks behind it; the parts repeat more than the
        whole."""
        parts = MARKED_WORD.findall(b"\n".join(chunks).decode())  # no chunk holds a line break
        self.letters.learn([[p[0] for p in parts]])
        self.marks.learn([[p[1] or p[2] for p in parts]])
        letters, marks = self.letters, self.marks
        return [letters[a] + marks[b or odd] for a, b, odd in parts]

    def _letters(self, chunks: list[str]) -> list[bytes]:
        """Words of letters are joined by blanks and cut where a token ends a word."""
        out: list[bytes] = []
        full = [c for c in chunks if c]
        for a in range(0, len(full), JOIN):
            part = full[a:a + JOIN]
            ids = np.array(self.ids(" ".join(part)), dtype="<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                raise ValueError("a word of letters is not one word for this tokenizer")
            packed, begin = ids.tobytes(), 0
            for end in (ends * 4).tolist():
                out.append(packed[begin:end])
                begin = end
        given = iter(out)
        return [next(given) if c else b"" for c in chunks]

    def _separated(self, chunks: list[str]) -> list[bytes]:
        """Anything between white space, joined by a separator word."""
        out: list[bytes] = [b""] * len(chunks)
        mark = self.ids(SEPARATOR)
        plain = []
        for i, chunk in enumerate(chunks):
            if not chunk:
                continue
            if SEPARATOR in chunk or len(mark) != 1:
                out[i] = self._one(chunk)
            else:
                plain.append(i)
        for a in range(0, len(plain), JOIN):
            part = plain[a:a + JOIN]
            text = f" {SEPARATOR} ".join([chunks[i] for i in part])
            ids = np.array(self.ids(text), dtype="<u4")
            cuts = np.flatnonzero(ids == mark[0])
            if len(cuts) != len(part) - 1:
                raise ValueError("the separator is not a word of its own for this tokenizer")
            packed, begin = ids.tobytes(), 0
            for i, end in zip(part, [*cuts.tolist(), len(ids)], strict=True):
                out[i] = packed[4 * begin:4 * end]
                begin = end + 1
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each whole text."""
        if not self.spaced:
            return [ids_array(p) for p in self.memory.packed([t.split() for t in texts])]
        lists = [spaced_chunks(t) for t in texts]
        try:
            return [ids_array(p) for p in self.memory.packed(lists)]
        except TypeError:  # a chunk ends in white space: cut that text at runs of white space
            pass
        get, out = self.memory.__getitem__, []  # all chunks are known; nothing below learns any
        for text, chunks in zip(texts, lists, strict=True):
            ids = list(map(get, chunks))
            if None in ids:
                ids = [self._one(c) for c in run_chunks(text)]
            out.append(ids_array(b"".join(ids)))
        return out


@functools.lru_cache(maxsize=2)
def library_of(path: str) -> Library:
    """One tokenizer per worker process and vocabulary file."""
    return Library(path)
