"""Language identification by prediction by partial matching (Cleary and Witten, 1984).

Per language a context tree over bytes is counted on training texts and frozen: for contexts of up to
four bytes, how often each byte followed (escape method C: a context that was followed ``t`` times by
``d`` different bytes escapes to the next shorter one with probability d / (t + d)). A text's code
length under a language is the sum, byte by byte, of the escapes down from the longest context known
there and of the byte's own cost in the first context that has seen it; below the empty context all
256 bytes are alike. The shortest code wins.

Frozen trees need no walk: the cost of a byte depends on at most five bytes, so it is worked out once
per known string of up to five bytes and language, and a text's bytes are looked up all at
once in hash tables of such strings, the longest first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import batches, mix, stored, texts_of
from finledger.llm.rule_ensemble import checksum_rest

ORDER = 4  # bytes of the longest context
UNDETERMINED = "und"
# Bounds of the fit: distinct training texts per language (on average; chosen by checksum, whole) and
# costs in the model (strings times languages).
SAMPLE = 2000
MODEL_COSTS = 4 << 20
AT_ONCE = 1 << 20  # bytes worked on together

LETTER = re.compile(rb"[A-Za-z]")
COUNTS = pa.schema([
    ("lang", pa.string()), ("size", pa.int32()), ("string", pa.int64()), ("n", pa.int64()),
])
PREDICTED = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def has_letter(text: bytes) -> bool:
    return bool(LETTER.search(text)) or any(map(str.isalpha, text.decode()))


def normal(text: bytes) -> bytes:
    """Lower case; letters' case says little about a language."""
    return text.decode().lower().encode()


def strings(data: np.ndarray, size: int) -> np.ndarray:
    """The strings of ``size`` bytes that end at each byte from the fifth on, as numbers."""
    out = data[ORDER:].astype(np.int64)
    for back in range(1, size):
        out |= data[ORDER - back:len(data) - back].astype(np.int64) << (8 * back)
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts, four blanks in front of each, as bytes, and which bytes are a text's own."""
    data = np.frombuffer(b"".join(b" " * ORDER + t for t in texts), dtype=np.uint8)
    own = np.ones(len(data), dtype=bool)
    sizes = np.array([len(t) + ORDER for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    for k in range(ORDER):
        own[begins + k] = False
    return data, own


class Strings:
    """A hash table of 64-bit strings; finds the row of each, or -1."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.rows = np.full(1 << bits, -1, dtype=np.int32)
        todo, at = np.arange(len(keys)), self._first(keys)
        while len(todo):  # open addressing: the first to claim a free slot gets it
            free = self.keys[at] == -1
            slots, who = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[who]
            self.keys[slots] = keys[todo[placed]]
            self.rows[slots] = todo[placed]
            rest = np.ones(len(todo), dtype=bool)
            rest[placed] = False
            todo, at = todo[rest], (at[rest] + 1) & int(self.mask)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.rows[at], -1)
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(self.mask)
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.rows[at[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out


class Trees:
    """Frozen context trees of some languages.

    ``counts`` has arrays (language, size, string, n): how often the language has the string.
    """

    def __init__(self, languages: list[str], counts: tuple[np.ndarray, ...]):
        language, size, string, n = counts
        self.languages = languages
        self.known: list[Strings] = []  # by length of the string less one
        self.costs: list[np.ndarray] = []
        self.contexts: list[Strings] = []  # by length of the context
        self.escapes: list[np.ndarray] = []
        for order in range(ORDER + 1):
            of = size == order + 1
            own, at = np.unique(string[of], return_inverse=True)
            many = np.zeros((len(own), len(languages)))
            many[at, language[of]] = n[of]
            context, within = np.unique(own >> 8, return_inverse=True)
            total = np.zeros((len(context), len(languages)))
            kinds = np.zeros_like(total)
            np.add.at(total, within, many)
            np.add.at(kinds, within, many > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
                direct = -np.log2(many / (total + kinds)[within])
            shorter = self.cost(own & ((1 << 8 * order) - 1), order - 1)
            cost = np.where(many > 0, direct, escape[within] + shorter)
            self.known.append(Strings(own))
            self.costs.append(cost.astype(np.float32))
            self.contexts.append(Strings(context))
            self.escapes.append(escape.astype(np.float32))

    def cost(self, wanted: np.ndarray, order: int) -> np.ndarray:
        """Bits of the last byte of each string of ``order + 1`` bytes, a column per language."""
        out = np.zeros((len(wanted), len(self.languages)), np.float32)
        todo = np.arange(len(wanted))
        while order >= 0 and len(todo):
            row = self.known[order].find(wanted)
            hit = row >= 0
            out[todo[hit]] += self.costs[order][row[hit]]
            todo, wanted = todo[~hit], wanted[~hit]
            context = self.contexts[order].find(wanted >> 8)
            seen = context >= 0
            out[todo[seen]] += self.escapes[order][context[seen]]
            wanted = wanted & ((1 << 8 * order) - 1)
            order -= 1
        out[todo] += 8
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each normalised text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        gathered, total = [], 0
        for number, text in enumerate(texts):
            gathered.append(number)
            total += len(text)
            if total >= AT_ONCE or number == len(texts) - 1:
                data, own = joined([texts[i] for i in gathered])
                of = np.repeat(gathered, [len(texts[i]) + ORDER for i in gathered])[own]
                places = np.flatnonzero(own) - ORDER
                for begin in range(0, len(places), AT_ONCE):
                    part = places[begin:begin + AT_ONCE]
                    if not len(part):
                        continue
                    window = data[part[0]:part[-1] + ORDER + 1]
                    found = strings(window, ORDER + 1)[part - part[0]]
                    bits = self.cost(found, ORDER)
                    mine = of[begin:begin + AT_ONCE]
                    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    out[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.float64)
                gathered, total = [], 0
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """The language of the shortest code, and its probability if all were equally likely
        before; ties go to the first by name."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        letters = [has_letter(t) for t in texts]
        bits = self.code_lengths([normal(t) if ok else b"" for t, ok in zip(texts, letters, strict=True)])
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        return (
            [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letters, strict=True)],
            [s if ok else 0.0 for s, ok in zip(share.tolist(), letters, strict=True)],
        )


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each string of one to five bytes occurs, per language and piece of the batch."""
    for batch in rows:
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
            by.setdefault(lang, []).append(normal(text))
        for lang, texts in by.items():
            data, own = joined(texts)
            for size in range(1, ORDER + 2):
                found, n = np.unique(strings(data, size)[own[ORDER:]], return_counts=True)
                yield from batches([{
                    "lang": [lang] * len(found), "size": np.full(len(found), size, np.int32),
                    "string": found, "n": n,
                }], COUNTS)


def string_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
) -> DataFrame:
    """(lang, size, string, n) of the training texts: a language's distinct texts outside the
    held-out fifth, all of them or, where there are many more than ``sample``, about so many with
    the smallest checksums of their text."""
    rows = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
    ).where((checksum_rest(F.col("key")) != 0) & F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("sum"))
    many = stored(
        rows.groupBy("lang").agg(F.approx_count_distinct("sum", 0.02).alias("texts")), "language-texts"
    )
    # the sum shifted to [0, 1): a share of it is a share of the texts
    share = F.shiftrightunsigned("sum", 11) / F.lit(float(1 << 53))
    taken = rows.join(many, "lang").where(share < F.lit(float(sample)) / F.col("texts"))
    # copies have one checksum; the text of any of them will do
    taken = taken.groupBy("lang", "sum").agg(F.first("text").alias("text"))
    counted = taken.select("lang", "text").mapInArrow(_count, "lang string, size int, string long, n long")
    return counted.groupBy("lang", "size", "string").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE, model_costs: int = MODEL_COSTS,
) -> Trees:
    """Trees of all languages of the training texts. Of strings that ``model_costs`` has no room for the
    rarest are left out (a string is never more frequent than what it is made of, so trees stay trees)."""
    counts = stored(string_counts(docs, key, text, lang, sample), "language-strings")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    room = model_costs // max(1, len(languages))
    kept = counts.orderBy(F.desc("n"), "size", "string", "lang").limit(room).toArrow()
    place = {name: i for i, name in enumerate(languages)}
    return Trees(languages, (
        np.array([place[v] for v in kept.column("lang").to_pylist()], dtype=np.int64),
        *(kept.column(c).to_numpy() for c in ("size", "string", "n")),
    ))


def identify_languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE, model_costs: int = MODEL_COSTS,
) -> DataFrame:
    """Every document's language, predicted from its whole text alone.

    Columns: the key, held_out (every fifth document by checksum of its key, a null key being an empty
    text; nothing is learned from these), lang_pred, score (the probability of lang_pred among
    the learned languages, all equally likely before). A text that is null or has no letter, and any
    text where there is nothing to learn from, is ``und`` with score 0. Equal texts are predicted
    alike, ties go to the first language by name, repeated training texts count once; texts of any length
    are read to the end. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs, key, text, lang, sample, model_costs))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names, scores = model.value.predict(texts_of(batch, "text"))
            yield from batches(
                [{"key": batch.column(0), "lang_pred": names, "score": scores}], PREDICTED
            )

    rows = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
    found = rows.mapInArrow(run, "key long, lang_pred string, score double")
    return found.select(
        F.col("key").alias(key), (checksum_rest(F.col("key")) == 0).alias("held_out"),
        "lang_pred", "score",
    )
