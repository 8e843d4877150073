"""Repeated passages found by recompression (Jez, 2013), and their words removed.

Words are named by a hash of their bytes; then rounds name runs and pairs: a run of one name becomes the name of
(name, length), and in each pair round the names are split into left and right ones by a bit, and
every left one followed by a right one becomes the name of the two. A name is computed from the
names it stands for, so all tasks agree on it without a common dictionary. Which symbols a text gets depends on
its surroundings only as far as the rounds have looked; that *reach* is tracked per symbol, and
a symbol whose reach lies inside a window is the same wherever the window's words occur.

A window of ``WINDOW`` words is filed under one such symbol of the highest level that it holds, by
the name of all words in its reach. So equal windows share their key: keys that occur once
reveal that no window under them is repeated, and windows under the others are verified against each
other by the name of all their words.

Spark counts the keys, hands each document those that are shared, gathers the windows under
shared keys, and hands each document the windows that start earlier elsewhere.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import batches, mix, texts_of

WINDOW = 20
ROUNDS = 4
BYTES_AT_ONCE = 1 << 20  # texts of neighbouring documents named together
HOT = 10_000  # documents under a key beyond which its windows are gathered one by one
NULL_KEY = -(1 << 63)  # null ids count as one id before all others
BASE = np.uint64(0x9E6C63D0876A9A47)
LEVELS = np.uint64(0xC2B2AE3D27D4EB4F)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BLANK = np.array([b in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)])
OCTETS = mix(np.arange(1, 257, dtype=np.uint64) * LEVELS)  # what each byte counts for


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as far as they were needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(cls.up):
            size = max(n + 1, 1 << 16)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            cls.up, cls.down = (np.ones(size, dtype=np.uint64) for _ in range(2))
            np.cumprod(np.full(size - 1, BASE), out=cls.up[1:])
            np.cumprod(np.full(size - 1, inverse), out=cls.down[1:])
        return cls.up[:n + 1], cls.down[:n + 1]


def prefix_names(values: np.ndarray) -> np.ndarray:
    """P[i] has the values before i as the digits of a number: P[i + 1] = P[i] * BASE + value.

    BASE is odd, so it has an inverse, and P[i] / BASE^i is a plain running sum.
    """
    up, down = Powers.to(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * down[1:], out=sums[1:])
    return sums * up


def names_between(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of the stretches from begin to end, from their values and their length."""
    size = end - begin
    up, _ = Powers.to(int(size.max()) if len(size) else 0)
    return mix(prefix[end] - prefix[begin] * up[size] + size.astype(np.uint64))


class Weights:
    """An odd number for each place of a word, as far as they were needed."""

    table = np.zeros(0, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> np.ndarray:
        if n > len(cls.table):
            cls.table = mix(np.arange(1, max(n, 1 << 10) + 1, dtype=np.uint64) * LEVELS) | np.uint64(1)
        return cls.table


def name_words(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, name) of the words among these bytes, the last of which is blank.

    Each place of a word has a weight of its own, and a name is the scrambled sum of bytes times
    weights. (Powers of a base would not do: modulo 2^64 some long words of two letters then have
    one name whatever the base.)
    """
    blank = BLANK[octets]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins = edge if blank[0] else np.concatenate([[0], edge])
    begin, end = begins[:len(begins) // 2 * 2:2], begins[1::2]
    names = np.zeros(len(begin), dtype=np.uint64)
    first = 0
    while first < len(begin):  # about a megabyte at a time, or a longer word
        last = max(first + 1, int(np.searchsorted(end, begin[first] + (1 << 20))))
        at, stop = begin[first], end[last - 1]
        own = begin[first:last] - at
        place = np.arange(stop - at) - np.repeat(own, np.diff(np.append(own, stop - at)))
        sums = np.zeros(stop - at + 1, dtype=np.uint64)
        np.cumsum(OCTETS[octets[at:stop]] * Weights.to(int(place.max()) + 1)[place], out=sums[1:])
        size = end[first:last] - begin[first:last]
        names[first:last] = mix(sums[own + size] - sums[own] + size.astype(np.uint64))
        first = last
    return begin, names


class Stretch:
    """The words of some texts side by side; ``begins`` and ``ends`` tell where a text's are."""

    def __init__(self, texts: list[bytes]):
        octets = np.frombuffer(b"\n".join([*texts, b""]) or b"\n", dtype=np.uint8)
        at, self.names = name_words(octets)
        text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.owner = np.searchsorted(text_ends, at, side="right")
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.prefix = prefix_names(self.names)

    def windows(self) -> np.ndarray:
        """Where windows begin: as many words of the document follow."""
        at = np.arange(len(self.names))
        return at[at + WINDOW <= self.ends[self.owner]]

    def symbols(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(begin, end) of the symbols' reach, level by level, the highest first.

        A reach that includes a document's edge leaves the document, so no window holds it. Both
        begins and ends rise from symbol to symbol.
        """
        at = np.arange(len(self.names))
        levels = [(at, at + 1)]
        if len(at):
            name, low, high, owner = _runs(self.names, self.owner)
            levels.append((low, high))
            for level in range(ROUNDS):
                name, low, high, owner = _pairs(
                    name, low, high, owner, self.begins[owner], self.ends[owner], level
                )
                levels.append((low, high))
        yield from reversed(levels)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(begins of windows, their keys): of the symbols of the highest level whose reach lies in
        the window, the smallest name."""
        at = self.windows()
        best = np.full(len(at), NONE)
        left = np.arange(len(at))
        for low, high in self.symbols():
            if not len(left):
                break
            near = np.maximum(low, 0)
            name = names_between(
                self.prefix, near, np.clip(high, near, np.minimum(near + WINDOW, len(self.names)))
            )
            first = np.searchsorted(low, at[left])
            last = np.searchsorted(high, at[left] + WINDOW, side="right")
            some = last > first
            best[left[some]] = _range_least(name, first[some], last[some])
            left = left[~some]
        return at, best

    def window_names(self, at: np.ndarray) -> np.ndarray:
        return names_between(self.prefix, at, at + WINDOW)


def _range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value of each range (not empty), from those of ranges of powers of two."""
    if not len(first):
        return values[:0]
    size = last - first
    power = np.frexp(size)[1] - 1
    out = np.empty(len(first), dtype=values.dtype)
    for k in range(int(power.max()) + 1):
        here = power == k
        out[here] = np.minimum(values[first[here]], values[last[here] - (1 << k)])
        if (1 << k) < len(values):
            values = np.minimum(values, np.append(values[1 << k:], np.full(1 << k, NONE)))
    return out


def _runs(names, owner):
    """Symbols for runs of one name; both neighbours were looked at."""
    first = np.concatenate([[True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])])
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(names))
    name = names[begin]
    long = mix(name + mix((end - begin).astype(np.uint64) * LEVELS))
    return np.where(end - begin > 1, long, name), begin - 1, end + 1, owner[begin]


def _pairs(name, low, high, owner, begins, ends, level):
    """One pair round. A pair looks at its two symbols; a left symbol that stays alone has looked at
    the one behind it, a right one at the one in front, and at a text's edge both look over it."""
    round_ = np.uint64((level + 1) * int(LEVELS) % (1 << 64))
    left = mix(name + round_) >> np.uint64(63) == 0
    same = np.concatenate([owner[1:] == owner[:-1], [False]])
    pair = left & same
    pair[:-1] &= ~left[1:]
    second = np.concatenate([[False], pair[:-1]])
    after = np.where(same, np.append(high[1:], 0), ends + 1)
    before = np.where(np.concatenate([[False], same[:-1]]), np.concatenate([[0], low[:-1]]), begins - 1)
    new_high = np.where(left, np.maximum(high, after), high)
    new_low = np.where(left | second, low, np.minimum(low, before))
    joined = mix(mix(name + LEVELS) * BASE + np.append(name[1:], np.uint64(0)))
    keep = ~second
    return np.where(pair, joined, name)[keep], new_low[keep], new_high[keep], owner[keep]


def stretches(rows: Iterable[pa.RecordBatch], text: int) -> Iterator[tuple[list, list[bytes]]]:
    """(rows' other columns, texts) of neighbouring rows, ``BYTES_AT_ONCE`` at a time."""
    others, texts, total = [], [], 0
    for batch in rows:
        own = texts_of(batch, batch.schema.names[text])
        rest = [c.to_pylist() for i, c in enumerate(batch.columns) if i != text]
        for i, t in enumerate(own):
            if texts and total + len(t) > BYTES_AT_ONCE:
                yield others, texts
                others, texts, total = [], [], 0
            others.append([c[i] for c in rest])
            texts.append(t)
            total += len(t)
    if texts:
        yield others, texts


def first_here(names: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks the first of equal names of one owner, in order."""
    _, at = np.unique(mix(names + mix(owner.astype(np.uint64) * LEVELS)), return_index=True)
    first = np.zeros(len(names), dtype=bool)
    first[at] = True
    return first


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where neighbouring rows begin to differ."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


KEYS = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("sum", pa.int64())])
FILED = pa.schema([
    ("key", pa.int64()), ("doc", pa.int64()), ("sum", pa.int64()), ("start", pa.int64()),
    ("names", pa.list_(pa.int64())),
])
EARLIER = pa.schema([("doc", pa.int64()), ("sum", pa.int64()), ("starts", pa.list_(pa.int64()))])
ROW = ["doc", "sum"]  # what tells rows apart: copies of one text under one id are alike


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _keys(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's keys, once each. Input: doc, sum, text."""
    for others, texts in stretches(rows, 2):
        stretch = Stretch(texts)
        at, keys = stretch.keys()
        owner = stretch.owner[at]
        new = run_starts(keys, owner)
        keys, owner = keys[new], owner[new]
        once = first_here(keys, owner)
        docs, sums = (np.array([o[i] for o in others], dtype=np.int64) for i in range(2))
        owner = owner[once]
        yield from batches(
            [{"key": _signed(keys[once]), "doc": docs[owner], "sum": sums[owner]}], KEYS
        )


def _file(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows under the given keys: for each run of neighbouring ones under one key the first
    start and the names. Only the first of a row's equal windows is filed; the others start
    earlier in the row itself. Input: id, doc, sum, text, given."""
    for others, texts in stretches(rows, 3):
        stretch = Stretch(texts)
        at, keys = stretch.keys()
        owner = stretch.owner[at]
        signed = _signed(keys)
        filed = np.zeros(len(at), dtype=bool)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i, (_, _, _, given) in enumerate(others):
            a, b = cuts[i], cuts[i + 1]
            filed[a:b] = np.isin(signed[a:b], np.array(given, dtype=np.int64))
        at, signed, owner = at[filed], signed[filed], owner[filed]
        names = stretch.window_names(at)
        first = first_here(names, owner)
        at, signed, owner, names = at[first], signed[first], owner[first], names[first]
        if not len(at):
            continue
        begin = run_starts(signed, at - np.arange(len(at)), owner)
        docs, sums = (np.array([o[i] for o in others], dtype=np.int64) for i in (1, 2))
        yield pa.RecordBatch.from_arrays([
            pa.array(signed[begin]), pa.array(docs[owner[begin]]), pa.array(sums[owner[begin]]),
            pa.array(at[begin] - stretch.begins[owner[begin]]),
            pa.ListArray.from_arrays(
                np.append(begin, len(at)).astype(np.int32), pa.array(_signed(names))
            ),
        ], schema=FILED)


def _later(key: np.ndarray, doc: np.ndarray, start: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Marks the windows with an equal one under the same key that starts earlier."""
    order = np.lexsort((start, doc, name, key))
    k, w, d, s = key[order], name[order], doc[order], start[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    later = np.zeros(len(k), dtype=bool)
    later[order] = (d != d[lead]) | (s != s[lead])
    return later


def _verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, the starts that have an earlier equal window. A key's rows are
    taken together: they are at most ``HOT`` documents' (others go another way)."""
    kept: list[pa.RecordBatch] = []

    def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        table = table.combine_chunks()
        names = table["names"].chunk(0)
        sizes = np.diff(names.offsets.to_numpy())
        row = np.repeat(np.arange(table.num_rows), sizes)
        step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doc = table["doc"].to_numpy()
        start = table["start"].to_numpy()[row] + step
        later = _later(table["key"].to_numpy()[row], doc[row], start, names.flatten().to_numpy())
        counts = np.bincount(row[later], minlength=table.num_rows)
        some = counts > 0
        ends = np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[some]), pa.array(table["sum"].to_numpy()[some]),
             pa.ListArray.from_arrays(ends, pa.array(start[later]))],
            schema=EARLIER,
        )

    for batch in rows:
        if not batch.num_rows:
            continue
        last = batch.column(0)[-1].as_py()
        same = batch.column(0).to_numpy() == last
        cut = int(np.argmax(same))
        if kept and kept[0].column(0)[0].as_py() == last:
            kept.append(batch)  # the whole batch belongs to the key at hand
            continue
        yield from judged(pa.Table.from_batches([*kept, batch.slice(0, cut)], batch.schema))
        kept = [batch.slice(cut)]
    if kept:
        yield from judged(pa.Table.from_batches(kept))


RESULT = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("kept_sha256", pa.string()),
])


def _covered(size: int, starts: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + WINDOW + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return np.cumsum(edge)[:size] > 0


def _removed(texts: list[bytes], handed: list[list | None]) -> Iterator[np.ndarray]:
    """Per text which words go: those of windows that start earlier elsewhere (handed in) or in
    the text itself."""
    stretch = Stretch(texts)
    at = stretch.windows()
    owner = stretch.owner[at]
    again = ~first_here(stretch.window_names(at), owner)
    again_at, again_owner = at[again], owner[again]
    cuts = np.searchsorted(again_owner, np.arange(len(texts) + 1))
    for i, lists in enumerate(handed):
        size = int(stretch.sizes[i])
        starts = again_at[cuts[i]:cuts[i + 1]] - stretch.begins[i]
        given = np.array([s for part in lists or [] for s in part], dtype=np.int64)
        yield _covered(size, np.concatenate([starts, given]))


def _finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: id, doc, sum, text, starts."""
    for others, texts in stretches(rows, 3):
        gone = list(_removed(texts, [o[3] for o in others]))
        words = [t.split() for t in texts]
        kept = [b" ".join([x for x, out in zip(w, g.tolist(), strict=True) if not out])
                if g.any() else b" ".join(w) for w, g in zip(words, gone, strict=True)]
        yield from batches([{
            "id": [o[0] for o in others], "n_words": [len(w) for w in words],
            "n_removed": [int(g.sum()) for g in gone],
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }], RESULT)


def cut_text(text: bytes, gone: np.ndarray) -> bytes:
    """The text without its removed words; what stands between two kept neighbours stays, and where
    words went one blank is left."""
    if not gone.any():
        return text
    out, at = [], 0
    previous = True
    for word, out_of in zip(text.split(), gone.tolist(), strict=True):
        begin = text.index(word, at)
        if not out_of:
            out.append(text[at:begin] if previous or not out else b" ")
            out.append(word)
        previous = not out_of
        at = begin + len(word)
    return b"".join(out)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, doc (the id without nulls), sum (a checksum of the text) and text."""
    return docs.selectExpr(
        f"CAST(`{key}` AS BIGINT) AS id",
        f"coalesce(CAST(`{key}` AS BIGINT), CAST('{NULL_KEY}' AS BIGINT)) AS doc",
        f"xxhash64(`{text}`) AS sum",
        f"`{text}` AS text",
    )


def earlier_windows(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc, sum, starts): per row the windows that start earlier in another row.

    ``rows`` has id, doc, sum and text. Keys of more than ``hot`` rows are not gathered in one
    task: their windows are grouped by name, first starts are combined before the shuffle, and
    the join with them is one that Spark splits where it is skewed. Lists are sets, so that
    copies of a text under one id count once.
    """
    keys = rows.select(*ROW, "text").mapInArrow(_keys, "key long, doc long, sum long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    crowded = F.col("docs") > hot
    handed = keys.join(shared, "key").groupBy(*ROW).agg(
        F.collect_set(F.when(~crowded, F.col("key"))).alias("few"),
        F.collect_set(F.when(crowded, F.col("key"))).alias("many"),
    )
    # all columns of the rows, so that the joins share one exchange of the documents
    filed = [
        rows.join(handed, ROW).where(F.size(given) > 0).select("id", *ROW, "text", given)
        .mapInArrow(_file, "key long, doc long, sum long, start long, names array<long>")
        for given in ("few", "many")
    ]
    cold = (
        filed[0].repartition("key").sortWithinPartitions("key")
        .mapInArrow(_verify, "doc long, sum long, starts array<long>")
    )
    single = filed[1].select("key", *ROW, F.posexplode("names").alias("step", "name"), "start")
    single = single.select("key", "name", *ROW, (F.col("start") + F.col("step")).alias("start"))
    first = single.groupBy("key", "name").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    crowded = (
        single.join(first, ["key", "name"]).where(F.struct("doc", "start") > F.col("first"))
        .select(*ROW, F.array("start").alias("starts"))
    )
    return cold.union(crowded).groupBy(*ROW).agg(F.collect_set("starts").alias("starts"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
) -> DataFrame:
    """Per document the words that remain when repeated windows go.

    Columns: the key, n_words, n_removed, kept_sha256 (of the kept words joined by blanks). A
    word goes if a window of 20 words that covers it starts earlier, too: in a document of smaller key
    or before in the same one; windows are those of the input. A null or empty text has no words; null
    keys are one key before all others; rows that share a key are one document id: equal starts in
    two of them are no repeat of each other, and each row loses the words of its own windows only
    (rows are told apart by the key and a checksum of the text); an empty table gives no rows; other
    columns are not read.
    """
    rows = _rows(docs, key, text)
    return (
        rows.join(earlier_windows(rows, hot), ROW, "left").select("id", *ROW, "text", "starts")
        .mapInArrow(_finish, "id long, n_words long, n_removed long, kept_sha256 string")
        .withColumnRenamed("id", key)
    )


def cut_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
) -> DataFrame:
    """The documents without repeated windows in their texts, all columns kept.

    Untouched texts stay as they are, a null text stays null, and a text may become empty.
    """
    starts = earlier_windows(_rows(docs, key, text), hot)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        whole = [(t or "").encode() for t in texts]
        gone = _removed(whole, [None if s is None else list(s) for s in lists])
        return pd.Series([
            None if old is None else cut_text(new, g).decode()
            for old, new, g in zip(texts, whole, gone, strict=True)
        ], dtype=object)

    doc = F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY))
    joined = docs.withColumns({"__doc": doc, "__sum": F.xxhash64(text)}).join(
        starts.toDF("__doc", "__sum", "__starts"), ["__doc", "__sum"], "left"
    )
    quoted = {c: F.col(f"`{c}`") for c in docs.columns}
    return joined.select(*[
        cut(quoted[c], F.col("__starts")).alias(c) if c == text else quoted[c] for c in docs.columns
    ])
