"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give spans of four kinds. The field is trained on a small labelled table
(``pii_labels``) of the forms that people write around the patterns; it tags words O or one of the
kinds from their shapes and their neighbours', and adds what reads as a kind without matching its
pattern: at signs and dots in brackets, parts set apart, phones without a plus, dotted
cards, long addresses, and secrets (keys and tokens behind a word that announces them). What it
tags is added only if it can be of that kind: a card passes Luhn, an address has its parts. It
decodes every word of a text, as one chain: what a word alone says is kept per distinct word, what
its neighbours say is added in arrays, and the chain falls apart at words where no other tag can win.
"""

import hashlib
import io
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain as joined

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.llm import pii_labels
from finledger.llm.common import batches, strings_of

KINDS = ("email", "ip", "card", "phone")
EVERY = (*KINDS, "secret")  # the kinds of the field
Span = tuple[int, int, str]  # begin, end (exclusive) in code points, kind

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile(r"[0-9@+]|[\[({](?:at|AT)[\])}]")
MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from the at sign on, so a long run of letters is walked once, not from each letter."""
    after = 0
    for tail in MAIL_TAIL.finditer(text):
        at = begin = tail.start()
        while begin > after and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at:
            after = tail.end()
            yield begin, after


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by begin and then kind."""
    if not MARKED.search(text):
        return []
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        # compared without reading the digits as a number: a part may be of any length
        if all(len(p := part.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for part in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if 12 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return in_order(found)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], EVERY.index(s[2])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


# ---- the field -------------------------------------------------------------------------------

TAGS = ("", *EVERY)  # 0: none
CONTEXT = 2
EDGES = "\"'()[]{}<>,;:!?."
BRACKETED = re.compile(r"[\[({](?:at|AT|dot|DOT|\.)[\])}]")
HEX = re.compile(r"[0-9a-fA-F]{16,}")
TURN = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")
MOST_WORDS = 9  # of one span: an address in four parts with its dots set apart has seven


def whole_shape(word: str) -> str:
    out, last, run = [], "", 0
    for c in word:
        kind = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        run = run + 1 if kind == last else 1
        if run == 1 or kind in "d" and run <= 4:
            out.append(kind)
        last = kind
    return "".join(out)


def bounded(part: str) -> str:
    """A long part of a feature by a hash of all of it."""
    if len(part) <= 64:
        return part
    return "#" + hashlib.blake2b(part.encode(), digest_size=16).hexdigest()


def shape(word: str) -> str:
    """Letters and digits as x, X and d, each run as one with its length up to four."""
    return bounded(whole_shape(word))


def coarse(word: str) -> str:
    """The shape with every run as one character."""
    return bounded(re.sub(r"(.)\1+", r"\1", whole_shape(word)))


def parts_of(word: str) -> tuple[str, ...]:
    """What a word and its neighbours look at: coarse shape, number of digits, the word itself, edges cut."""
    core = word.strip(EDGES)
    return coarse(core or word), str(min(len(only_digits(word)), 20)), bounded(core.lower())


def signs_of(word: str) -> str:
    """The at signs and dots that stand in brackets, whatever the brackets."""
    return " ".join(sign[1:-1] for sign in BRACKETED.findall(word.lower())[:3])


def own_features(word: str) -> tuple[list[str], list[str], int]:
    """Of ``word_features`` those that no neighbour changes: the first ones, the later ones, and its
    length in eights."""
    core = word.strip(EDGES)
    own, digits, _ = parts_of(word)
    turns = sum(1 for _ in TURN.finditer(core))
    length = min(len(core) // 8, 6)
    return [
        "bias", f"shape={shape(core)}", f"coarse={own}", f"digits={digits}",
        f"at={core.count('@')}", f"dots={min(core.count('.'), 5)}", f"plus={word[:1] == '+'}",
        f"paren={word[:1] == '('}{word[-1:] == ')'}",
    ], [
        f"signs={signs_of(word)}", f"colons={min(core.count(':'), 8)}", f"long={length}",
        f"turns={min(turns // 3, 6)}{HEX.fullmatch(core) is not None}",
    ], length


def word_features(words: list[str], at: int) -> list[str]:
    """What the field sees of a word: its own shapes and parts, its neighbours' shapes, and the
    two words before it."""
    word = words[at]
    own, digits, _ = parts_of(word)
    before, digits_before, said = parts_of(words[at - 1]) if at else ("^", "^", "^")
    said_first = parts_of(words[at - 2])[2] if at > 1 else "^"
    after, digits_after, _ = parts_of(words[at + 1]) if at + 1 < len(words) else ("$", "$", "$")
    head, (signs, colons, long, turns), length = own_features(word)
    return [
        *head, f"before={before}", f"after={after}",
        f"before+own={before} {own}", f"own+after={own} {after}",
        f"counts={digits_before} {digits} {digits_after}", f"said={said}", f"said first={said_first}",
        signs, colons, f"signs before={signs_of(words[at - 1]) if at else ''}",
        f"signs after={signs_of(words[at + 1]) if at + 1 < len(words) else ''}",
        long, turns, f"long after={length} {said} {said_first}",
    ]


@dataclass(frozen=True)
class Chain:
    words: list[str]
    spans: list[tuple[int, int]]


def chains(text: str) -> Iterator[Chain]:
    """The words of the whole text as one chain: the field decodes every position, marked or not,
    since its transitions carry a tag past the words that hold a digit, an at sign or a plus."""
    spans = [m.span() for m in WORD.finditer(text)]
    if spans:
        yield Chain([text[a:b] for a, b in spans], spans)


@dataclass(frozen=True)
class Field:
    names: dict[str, int]
    emission: np.ndarray  # (features + 1, tags), the last row for unknown features
    transition: np.ndarray  # (tags, tags)
    caution: float  # what a path must gain over no tag, for each word

    @cached_property
    def lexicon(self) -> "Lexicon":
        return Lexicon(self.names, self.emission)

    def tags(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best tags of each sequence of words (which hold no blanks)."""
        if not sequences:
            return []
        ids, inside = self.lexicon.line(sequences)
        scores = self.lexicon.scores(ids, inside)
        scores[:, 0] += self.caution
        open_ = self._open(scores, ids, inside)
        whole = np.zeros(len(ids), dtype=np.int64)
        at = inside[open_]
        place = np.full(len(ids), -1)  # of a word's scores
        place[inside] = np.arange(len(inside))
        if len(at):
            breaks = np.flatnonzero(np.diff(at) > 1) + 1
            begin, end = at[np.r_[0, breaks]], at[np.r_[breaks - 1, len(at) - 1]] + 1
            order = np.argsort(end - begin, kind="stable")
            done = 0
            while done < len(order):  # neighbours in length share a batch: little is padded
                size = (end - begin)[order[done:]]
                few = max(1, int(np.searchsorted(size * np.arange(1, len(size) + 1), CELLS, "right")))
                some = order[done:done + few]
                self._decode(whole, scores, place, begin[some], end[some])
                done += few
        first = np.cumsum([0] + [len(s) + PADDING for s in sequences]) + BEFORE
        return [whole[a:a + len(s)] for a, s in zip(first, sequences)]

    def _open(self, scores: np.ndarray, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """The words at which a best path can have a tag.

        A tag that is behind none by more than its transitions can gain, from any tags that the
        words beside it can have, is on no best path: none in its place would be better. What is
        struck out at a word leaves its neighbours less to gain, so this is done again. Where only
        none is left the chain falls apart: what lies between is decoded on its own.
        """
        k = len(TAGS)
        sets = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1 == 1
        at_end = np.zeros((1, k))
        gains = []
        for more in (self.transition - self.transition[:, :1], (self.transition - self.transition[:1]).T):
            most = np.where(sets[1:, :, None], more[None], -np.inf).max(axis=1)
            gains.append(np.concatenate([at_end, most]))  # set 0: no word there
        left = np.zeros(len(ids), dtype=np.int64)
        left[inside] = (1 << k) - 1
        behind = scores[:, :1] - scores - MARGIN
        some = np.arange(len(inside))
        for _ in range(ROUNDS):
            at = inside[some]
            can = behind[some] <= gains[0][left[at - 1]] + gains[1][left[at + 1]]
            can[:, 0] = True
            left[at] &= np.packbits(can, axis=1, bitorder="little")[:, 0]
            some = some[left[at] > 1]
        return left[inside] > 1

    def _decode(self, whole: np.ndarray, scores: np.ndarray, place: np.ndarray, begin: np.ndarray,
                end: np.ndarray) -> None:
        """Viterbi over a batch of stretches at once; a word beside a stretch has no tag."""
        sizes = end - begin
        longest, k, rows = int(sizes.max()), len(TAGS), np.arange(len(sizes))
        own = scores[place[np.minimum(begin[:, None] + np.arange(longest), end[:, None] - 1)]]
        back = np.zeros((len(sizes), longest, k), dtype=np.int8)
        best = own[:, 0] + np.where(place[begin - 1, None] >= 0, self.transition[0], 0)
        ended = best.copy()
        for t in range(1, longest):
            step = best[:, :, None] + self.transition[None]
            back[:, t] = step.argmax(axis=1)
            best = step.max(axis=1) + own[:, t]
            ended = np.where(sizes[:, None] > t, best, ended)
        path = (ended + np.where(place[end, None] >= 0, self.transition[:, 0], 0)).argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            on = sizes > t
            whole[begin[on] + t] = path[on]
            path = np.where(on, back[rows, t, path], path)


ROUNDS = 8  # of striking out; what is open then is decoded
MARGIN = 1e-6  # far above the rounding of a sum of scores
CELLS = 20_000  # words of stretches decoded at once
MOST_KEPT = 1 << 17  # distinct words that are kept
BEFORE, PADDING = 2, 3  # places before a sequence, and before and behind it
# A short word without digits and brackets has the features of its letters' cases, but for what it says.
PLAIN = re.compile(r"[^0-9\[({]{1,15}")


class Cases(dict):
    """The shape of each character, by code point."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        shape = "X" if c.isupper() else "x" if c.isalpha() else c
        return self.setdefault(code, shape)


# What is kept of a form: rows of its later own features and of those of its neighbours, and codes
# of its parts in the features of several words.
(SIGNS, COLONS, LONG, TURNS, AS_BEFORE, AS_AFTER, SIGNS_BEFORE, SIGNS_AFTER, COARSE, DIGITS,
 LENGTH) = range(11)


class Lexicon(dict):
    """Distinct words by number: their form, which is all that features see of a word but what it
    says, times the number of words that features know, plus the number of what it says.

    The scores are the sums of the weights of ``word_features``, in the same order.
    """

    def __init__(self, names: dict[str, int], emission: np.ndarray):
        super().__init__()
        self.names, self.emission, self.unknown = names, emission, len(names)
        self.codes: list[dict[str, int]] = [{}, {}, {}]  # coarse shapes, digits, words; 0: unknown
        found = {kind: [] for kind in ("before+own", "own+after", "counts", "long after")}
        of = {"before+own": (0, 0), "own+after": (0, 0), "counts": (1, 1, 1), "long after": (2, 2)}
        said: dict[str, list[tuple[int, int]]] = {"said": [], "said first": []}
        for name, row in names.items():
            kind, _, rest = name.partition("=")
            if kind in said:
                said[kind].append((self.code(2, rest), row))
            elif kind in of:
                parts = rest.split(" ")
                lead = [int(parts.pop(0))] if kind == "long after" else []
                if len(parts) == len(of[kind]):
                    found[kind].append(([*lead, *map(self.code, of[kind], parts)], row))
        self.sizes = [len(c) + 1 for c in self.codes]
        self.together = {}
        for kind, rows in found.items():
            size = self.sizes[of[kind][0]]
            keys = np.array([self.key(codes, size) for codes, _ in rows] + [-1], dtype=np.int64)
            order = np.argsort(keys)
            self.together[kind] = keys[order], np.array([r for _, r in rows] + [self.unknown])[order]
        self.said = {kind: np.full(self.sizes[2], self.unknown) for kind in said}
        for kind, rows in said.items():
            for code, row in rows:
                self.said[kind][code] = row
        self.drop()

    def __reduce__(self):
        return Lexicon, (self.names, self.emission)

    def code(self, of: int, part: str) -> int:
        return self.codes[of].setdefault(part, len(self.codes[of]) + 1)

    @staticmethod
    def key(codes, size: int):
        out = codes[0]
        for code in codes[1:]:
            out = out * size + code
        return out

    def drop(self) -> None:
        self.clear()
        self.cases = Cases()
        self.plain: dict[str, int] = {}
        self.forms: dict[tuple, int] = {}
        self.kept = np.zeros((256, LENGTH + 1), dtype=np.int64)
        self.own = np.zeros((256, len(TAGS)))
        self.edges = [self.form((), (), edge, edge, "", 0) * self.sizes[2] + self.codes[2].get(edge, 0)
                      for edge in "^$"]

    def __missing__(self, word: str) -> int:
        if PLAIN.fullmatch(word):
            cases = word.translate(self.cases)
            form = self.plain.get(cases)
            if form is None:
                form = self.plain[cases] = self.form_of(cases)
            said = word.strip(EDGES).lower()
        else:
            form, said = self.form_of(word), parts_of(word)[2]
        self[word] = number = form * self.sizes[2] + self.codes[2].get(said, 0)
        return number

    def form_of(self, word: str) -> int:
        head, tail, length = own_features(word)
        own, digits, _ = parts_of(word)
        return self.form(head, tail, own, digits, signs_of(word), length)

    def form(self, head, tail, own: str, digits: str, signs: str, length: int) -> int:
        row, n = self.names.get, self.unknown
        first = tuple(row(f, n) for f in head)
        rows = (
            *([row(f, n) for f in tail] or [n] * 4), row(f"before={own}", n), row(f"after={own}", n),
            row(f"signs before={signs}", n), row(f"signs after={signs}", n),
            self.codes[0].get(own, 0), self.codes[1].get(digits, 0), length,
        )
        number = self.forms.setdefault((first, rows), len(self.forms))
        if number == len(self.kept):
            self.kept = np.concatenate([self.kept, np.zeros_like(self.kept)])
            self.own = np.concatenate([self.own, np.zeros_like(self.own)])
        self.kept[number] = rows
        self.own[number] = 0
        for f in first:
            self.own[number] += self.emission[f]
        return number

    def line(self, sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words in one array, with places around each sequence, and where the
        words are."""
        if len(self) > MOST_KEPT:
            self.drop()
        sizes = np.array([len(s) for s in sequences])
        words = np.fromiter(map(self.__getitem__, joined.from_iterable(sequences)), np.int64, int(sizes.sum()))
        inside = np.arange(len(words)) + BEFORE + PADDING * np.repeat(np.arange(len(sizes)), sizes)
        ids = np.full(len(words) + PADDING * len(sizes), self.edges[0])
        ids[np.cumsum(sizes + PADDING) - 1] = self.edges[1]
        ids[inside] = words
        return ids, inside

    def scores(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """What speaks for each tag at each word, before the transitions."""
        form, said = np.divmod(ids, self.sizes[2])
        own, before, after = (self.kept[form[inside + d]] for d in (0, -1, 1))
        said, said_first = said[inside - 1], said[inside - 2]
        out = self.own[form[inside]]

        def add(rows: np.ndarray) -> None:
            known = np.flatnonzero(rows != self.unknown)
            if 2 * len(known) > len(rows):
                out[:] += self.emission[rows]
            else:
                out[known] += self.emission[rows[known]]

        def together(kind: str, size: int, *codes: np.ndarray) -> None:
            keys, rows = self.together[kind]
            key = self.key(codes, size)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            add(np.where(keys[at] == key, rows[at], self.unknown))

        coarse, digits, words = self.sizes
        add(before[:, AS_BEFORE])
        add(after[:, AS_AFTER])
        together("before+own", coarse, before[:, COARSE], own[:, COARSE])
        together("own+after", coarse, own[:, COARSE], after[:, COARSE])
        together("counts", digits, before[:, DIGITS], own[:, DIGITS], after[:, DIGITS])
        add(self.said["said"][said])
        add(self.said["said first"][said_first])
        add(own[:, SIGNS])
        add(own[:, COLONS])
        add(before[:, SIGNS_BEFORE])
        add(after[:, SIGNS_AFTER])
        add(own[:, LONG])
        add(own[:, TURNS])
        together("long after", words, own[:, LENGTH], said, said_first)
        return out


def fit(table: list[tuple[list[str], list[int]]], steps: int = 100, decay: float = 1e-3,
        least: int = 3, caution: float = 2.0) -> Field:
    """A field from labelled sequences (words, tags), by gradient steps on the likelihood.

    Features seen in fewer than ``least`` words are left out. An empty table gives a field that
    tags nothing.
    """
    table = [(w, t) for w, t in table if w]
    seen: dict[str, int] = {}
    rows = [[word_features(w, j) for j in range(len(w))] for w, _ in table]
    for sequence in rows:
        for word in sequence:
            for f in word:
                seen[f] = seen.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    k, unknown = len(TAGS), len(names)
    emission, transition = np.zeros((unknown + 1, k)), np.zeros((k, k))
    if not table:
        return Field(names, emission, transition, caution)
    sizes = np.array([len(w) for w, _ in table])
    n, longest, width = len(table), int(sizes.max()), len(rows[0][0])
    ids = np.full((n, longest, width), unknown)
    gold = np.zeros((n, longest), dtype=np.int64)
    for i, (sequence, (_, tags)) in enumerate(zip(rows, table, strict=True)):
        ids[i, :len(sequence)] = [[names.get(f, unknown) for f in word] for word in sequence]
        gold[i, :len(tags)] = tags
    inside = np.arange(longest)[None] < sizes[:, None]
    pair = inside[:, 1:]
    want_t = np.zeros((k, k))
    np.add.at(want_t, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    onehot = np.eye(k)[gold] * inside[..., None]
    word_ids = ids[inside]
    seen_ids = word_ids.ravel()
    means = [np.zeros_like(emission), np.zeros_like(transition)]
    squares = [np.zeros_like(emission), np.zeros_like(transition)]
    for step in range(1, steps + 1):
        score = np.zeros((n, longest, k))
        score[inside] = emission[word_ids].sum(axis=1)
        forward, backward = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = _logsum(forward[:, t - 1][:, :, None] + transition[None], 1) + score[:, t]
            forward[:, t] = np.where(inside[:, t, None], new, forward[:, t - 1])
        total = _logsum(forward[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            new = _logsum(transition[None] + (score[:, t + 1] + backward[:, t + 1])[:, None], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], new, 0)
        chance = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
        error = np.repeat((onehot - chance)[inside], width, axis=0)
        grad_e = np.stack([np.bincount(seen_ids, error[:, t], unknown + 1) for t in range(k)], axis=1)
        both = (forward[:, :-1, :, None] + transition[None, None]
                + (score + backward)[:, 1:, None, :] - total[:, None, None, None])
        grad_t = want_t - (np.exp(np.where(pair[..., None, None], both, -np.inf))).sum(axis=(0, 1))
        grad_e[unknown] = 0
        for i, (weights, grad) in enumerate(((emission, grad_e), (transition, grad_t))):
            grad = grad / n - decay * weights
            means[i] = 0.9 * means[i] + 0.1 * grad
            squares[i] = 0.99 * squares[i] + 0.01 * grad * grad
            scale = np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8
            weights += 0.1 * means[i] / (1 - 0.9**step) / scale
    return Field(names, emission, transition, caution)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def labelled(text: str, spans: list[Span]) -> list[tuple[list[str], list[int]]]:
    """The chains of a text with a tag per word, the kind of the span that covers it."""
    out = []
    for chain in chains(text):
        tags = [0] * len(chain.words)
        for begin, end, kind in spans:
            for i, (a, b) in enumerate(chain.spans):
                if a < end and begin < b:
                    tags[i] = TAGS.index(kind)
        out.append((chain.words, tags))
    return out


def example(pieces: list[tuple[str, str]]) -> tuple[list[str], list[int]]:
    """The words and tags of a sentence given as pieces of text with their kinds."""
    words, tags = [], []
    for piece, kind in pieces:
        for word in WORD.findall(piece):
            # signs between a secret and its announcement are no part of it
            sign = kind == "secret" and not any(c.isalnum() for c in word)
            words.append(word)
            tags.append(TAGS.index("" if sign else kind))
    return words, tags


def label_table(spark: SparkSession, sentences: int = 3000, seed: int = 1) -> DataFrame:
    """A small labelled table (words, tags), made by rule; its size bounds the fit only."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [example(pii_labels.sentence(n, seed)) for n in batch.column(0).to_pylist()]
            yield from batches([{"words": [w for w, _ in found], "tags": [t for _, t in found]}], LABELLED)

    return spark.range(0, sentences, 1, 1).mapInArrow(run, "words array<string>, tags array<long>")


LABELLED = pa.schema([("words", pa.list_(pa.string())), ("tags", pa.list_(pa.int64()))])


def train(labels: DataFrame, caution: float = 0.5) -> Field:
    """A field from a small labelled table (words, tags), fitted in one task; the order of its rows
    does not matter, an empty table gives a field that tags nothing."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [(list(w or ()), list(t or ())) for batch in rows
                 for w, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        model = fit(sorted(table), caution=caution)
        out = io.BytesIO()
        np.savez(out, emission=model.emission, transition=model.transition)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(model.names)], pa.list_(pa.string())), pa.array([out.getvalue()])],
            names=["names", "weights"],
        )

    found = labels.select("words", "tags").coalesce(1).mapInArrow(
        run, "names array<string>, weights binary"
    ).first()
    if found is None:
        return fit([], caution=caution)
    with np.load(io.BytesIO(bytes(found["weights"]))) as weights:
        names = {f: i for i, f in enumerate(found["names"])}
        return Field(names, weights["emission"], weights["transition"], caution)


def trained(spark: SparkSession) -> Field:
    """The field of the given labelled table."""
    return train(label_table(spark))


# What a stretch of words must read as to be of a kind; brackets around an at sign or a dot are
# undone first, and blanks between parts.
ADDRESS = re.compile(r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}")
QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
CARD_SIGNS = re.compile(r"[0-9](?:[\x20./_-]{0,2}[0-9])+")
PHONE_SIGNS = re.compile(r"[(+]?[0-9](?:[\x20()./-]{0,2}[0-9])+")
SECRET = re.compile(r"[A-Za-z0-9_+/-]{16,}")
OPEN, CLOSE = r"\s*[\[({]\s*", r"\s*[\])}]\s*"
AT_SIGN = re.compile(OPEN + "at" + CLOSE + r"|\s*@\s*")
DOT_SIGN = re.compile(OPEN + r"(?:dot|\.)" + CLOSE + r"|\s+\.\s+")
LONGEST = 400  # code points of a span that the field may add; none of the kinds is longer


def is_address(text: str) -> bool:
    if QUAD.fullmatch(text):
        return all(int(part) <= 255 for part in text.split("."))
    if text.count(":") < 3 or "%" in text or not any(c.isdigit() for c in text):
        return False
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def reads_as(kind: str, text: str) -> bool:
    """Whether a text can be of a kind."""
    if len(text) > LONGEST:
        return False
    if kind == "email":
        return ADDRESS.fullmatch(AT_SIGN.sub("@", DOT_SIGN.sub(".", text.lower()))) is not None
    if kind == "ip":
        return is_address(DOT_SIGN.sub(".", text))
    digits = only_digits(text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and bool(CARD_SIGNS.fullmatch(text)) and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and bool(PHONE_SIGNS.fullmatch(text)) and text != digits
    return SECRET.fullmatch(text) is not None and digits != "" and digits != text


def narrowed(text: str, begin: int, end: int, kind: str) -> tuple[int, int]:
    """A stretch without the signs around it; of a secret, its longest run of letters and digits."""
    if kind == "secret":
        runs = SECRET.finditer(text, begin, min(end, begin + LONGEST))
        return max((m.span() for m in runs), key=lambda s: s[1] - s[0], default=(begin, begin))
    edges = EDGES if kind != "phone" else EDGES.replace("(", "").replace(")", "")
    while begin < end and text[begin] in edges:
        begin += 1
    while begin < end and text[end - 1] in edges:
        end -= 1
    if kind == "ip" and text[end:end + 1] == ":" and text[end - 1:end] == ":":
        end += 1
    return begin, end


def added_spans(text: str, base: list[Span], parts: list[Chain], tags: list[np.ndarray]) -> list[Span]:
    """Of words with one tag that no pattern has touched, the longest stretches that read as its
    kind, from the left."""
    out = []
    starts = [s[0] for s in base]
    reach = np.maximum.accumulate([s[1] for s in base]) if base else ()

    def free(begin: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at == 0 or reach[at - 1] <= begin

    for chain, path in zip(parts, tags, strict=True):
        own = {i: int(path[i]) for i in np.flatnonzero(path).tolist() if free(*chain.spans[i])}
        after = 0
        for i, tag in own.items():
            last = i
            while i >= after and last < i + MOST_WORDS and own.get(last) == tag:
                last += 1
            for j in range(last, i, -1):
                begin, end = narrowed(text, chain.spans[i][0], chain.spans[j - 1][1], TAGS[tag])
                if begin < end and reads_as(TAGS[tag], text[begin:end]):
                    out.append((begin, end, TAGS[tag]))
                    after = j
                    break
    return out


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(spans of the patterns, all spans) of each text; the words of many are decoded together."""
    out, begin = [], 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= DECODED):
            size += len(texts[end])
            end += 1
        some = texts[begin:end]
        for text, path in zip(some, field.tags([WORD.findall(t) for t in some]), strict=True):
            own = base_spans(text)
            # words without a tag add nothing, so where they stand is not asked
            more = added_spans(text, own, list(chains(text)), [path]) if path.any() else []
            out.append((own, in_order([*own, *more])))
        begin = end
    return out


DECODED = 500_000  # code points of texts decoded at once
FOUND = pa.schema([
    ("key", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
    ("spans", pa.string()),
])


def find_in_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None
) -> DataFrame:
    """Personal data of every whole text.

    Columns: the key, n_email, n_ip, n_card, n_phone (spans of the patterns), base_sha256 (of
    their list kind:begin:end), spans (the list of all spans, the field's included, among them
    those of the kind secret). A null or empty
    text has none; equal rows are searched alike; an empty table gives no rows; other columns are
    not read. Without a field the one of the given labelled table is trained.
    """
    model = field or trained(docs.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = find(strings_of(batch, "text"), model)
            columns = {"key": batch.column(0)}
            for kind in KINDS:
                columns[f"n_{kind}"] = [sum(s[2] == kind for s in own) for own, _ in found]
            columns["base_sha256"] = [
                hashlib.sha256(listed(own).encode()).hexdigest() for own, _ in found
            ]
            columns["spans"] = [listed(every) for _, every in found]
            yield from batches([columns], FOUND)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
    return rows.mapInArrow(
        run, f"key long, {counts}, base_sha256 string, spans string"
    ).withColumnRenamed("key", key)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one
    stretch named after the first."""
    out, at, i = [], 0, 0
    while i < len(spans):
        begin, end, kind = spans[i]
        while i < len(spans) and spans[i][0] < max(end, begin + 1):
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:begin], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None
) -> DataFrame:
    """The documents with the spans in their text masked, all columns kept; a null text stays
    null."""
    model = field or trained(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        whole = [t or "" for t in texts]
        found = find(whole, model)
        return pd.Series([
            None if t is None else masked(t, every)
            for t, (_, every) in zip(texts, found, strict=True)
        ], dtype=object)

    return docs.withColumn(text, mask(F.col(text)))
