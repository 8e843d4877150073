"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point if their common prefix
and their common suffix together reach the longer one's length minus one. Words are written as
rows of padded code-point matrices, once flush left and once flush right, and blocks of rows are
compared column by column, every pair of a block pair at once.

Not all blocks need to meet. With N as the longer length, an edit at N // 2 or behind leaves the first
N // 2 code points alike, one in front of that the last N - N // 2. So a word goes to four groups (as the
longer and as the shorter of a pair, by its first and by its last half), a pair is compared where it
meets and counted in exactly one group. Groups beyond a tile's size are cut into tiles, and each pair
of tiles is a group of its own: the work of a crowded half is spread over tasks, none is left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import batches, stored, texts_of

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
TILE_ROWS = 2048
CELLS = 4 << 20  # code points of a matrix: longer words have smaller tiles
SMALL = 24  # groups up to here are compared many at a time
DISTINCT = 200_000  # words that a worker counts before it hands them on

WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = pa.schema([
    ("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string()),
])


def _altered(own: Counter, key: object, every: int) -> dict[str, int]:
    """The counts of a document's runs with every ``every``-th run, by checksum, one code point
    short."""
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    out: dict[str, int] = {}
    for run, n in own.items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] = out.get(run, 0) + n
    return out


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    altered_every: int | None = None,
) -> DataFrame:
    """(word, n): how often each run of letters (A-Z lower-cased, and U+00C0 to U+00FF as they are)
    of ``least_length`` code points or more occurs in all whole texts.

    With ``altered_every`` a run of a document whose checksum of ``<key>:<run>`` it divides loses
    one code point first, which plants misspellings; a null key is an empty text there.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in rows:
            for own, whole in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                found: dict[str, int] = Counter(runs.findall(whole.translate(LOWER).decode()))
                if altered_every:
                    found = _altered(found, own, altered_every)
                for word, n in found.items():
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > DISTINCT:
                    yield from batches([{"word": list(counts), "n": list(counts.values())}], WORDS)
                    counts = {}
        if counts:
            yield from batches([{"word": list(counts), "n": list(counts.values())}], WORDS)

    rows = docs.selectExpr(f"CAST(`{key}` AS STRING) AS key", f"`{text}` AS text").mapInArrow(
        run, "word string, n long"
    )
    return (
        rows.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    )


def _halves(word: Column) -> Column:
    """The four groups of a word: 2 N and kind (0: first half, 1: last half), and the half's hash."""
    size = F.length(word)
    out = []
    for longer in (size, size + 1):
        half = F.floor(longer / 2).cast("int")
        first = F.substring(word, F.lit(1), half)
        last = F.substring(word, size - (longer - half) + 1, longer - half)
        out += [
            F.struct((longer * 2 + kind).alias("kind"), F.xxhash64(piece).alias("half"))
            for kind, piece in enumerate((first, last))
        ]
    return F.array(*out)


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flush-left and flush-right code-point matrices, zero elsewhere, and the lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    if codes.max(initial=0) < 256:
        codes = codes.astype(np.uint8)
    left, right = (np.zeros((len(words), width), codes.dtype) for _ in range(2))
    left[np.arange(width) < sizes[:, None]] = codes
    right[np.arange(width) >= width - sizes[:, None]] = codes
    return left, right, sizes


def tile(
    left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, common prefix) of the pairs of two blocks of rows that are one edit
    apart."""
    width = left.shape[1]
    kind = np.uint8 if width < 128 else np.int32
    found = []
    for begin in range(0, len(a), 256):
        mine = a[begin:begin + 256]
        common = [np.zeros((len(mine), len(b)), kind) for _ in range(2)]
        for rows, columns, total in ((left, range(width), common[0]),
                                     (right, range(width - 1, -1, -1), common[1])):
            alike = np.ones(total.shape, bool)
            for c in columns:
                alike &= rows[mine, c][:, None] == rows[b, c][None]
                total += alike
                if not alike.any():
                    break
        x, y = np.nonzero(common[0] + common[1] >= width - 1)
        found.append((mine[x], b[y], common[0][x, y]))
    return tuple(np.concatenate(p) for p in zip(*found, strict=True)) if found else (a[:0], b[:0], a[:0])


def pairs_of(
    left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for given pairs of rows."""
    width = left.shape[1]
    out = []
    step = max(1, CELLS // max(1, width))
    for begin in range(0, len(x), step):
        a, b = x[begin:begin + step], y[begin:begin + step]
        differs = np.pad(left[a] != left[b], ((0, 0), (0, 1)), constant_values=True)
        prefix = differs.argmax(axis=1)
        differs = np.pad((right[a] != right[b])[:, ::-1], ((0, 0), (0, 1)), constant_values=True)
        near = prefix + differs.argmax(axis=1) >= width - 1
        out.append((a[near], b[near], prefix[near]))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True)) if out else (x[:0], y[:0], x[:0])


def neighbours(
    words: list[str], kind: int, begins: np.ndarray, tiled: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near words (rows) in groups of one kind, each group's rows next to each other.

    ``tiled`` tells rows of a group that compares two tiles, ``side`` which of both a row is of.
    """
    width = kind // 2
    left, right, sizes = matrices(words, width)
    ends = np.append(begins[1:], len(words))
    long = sizes == width
    x_out, y_out, prefix_out = [], [], []

    def add(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        for out, part in zip((x_out, y_out, prefix_out), found, strict=True):
            out.append(part.astype(np.int64))

    small = (ends - begins <= SMALL) & ~tiled[begins]
    end_of = np.repeat(ends, ends - begins)
    rows = np.flatnonzero(np.repeat(small, ends - begins))
    for step in range(1, SMALL):
        rows = rows[rows + step < end_of[rows]]
        if not len(rows):
            break
        some = rows[long[rows] | long[rows + step]]
        add(pairs_of(left, right, some, some + step))
    for begin, end in zip(begins[~small].tolist(), ends[~small].tolist(), strict=True):
        own = np.arange(begin, end)
        if tiled[begin]:
            low, high = own[side[own] == side[own].min()], own[side[own] != side[own].min()]
            add(tile(left, right, low[long[low]], high))
            add(tile(left, right, low[~long[low]], high[long[high]]))
        else:
            whole = own[long[own]]
            a, b, prefix = tile(left, right, whole, whole)
            upper = a < b
            add((a[upper], b[upper], prefix[upper]))
            add(tile(left, right, whole, own[~long[own]]))
    x, y, prefix = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (x_out, y_out, prefix_out))
    counted = (prefix >= width // 2) == (kind % 2 == 0)
    return x[counted], y[counted]


def _partial(words: list[str], n: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict:
    """Per word of these pairs: how many near words, and the best of them."""
    own, other = np.concatenate([x, y]), np.concatenate([y, x])
    order = np.lexsort((other, -n[other], own))  # rows of a group are in code-point order
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    return {
        "word": [words[i] for i in own[first]], "near": np.diff(np.append(first, len(own))),
        "best_n": n[other[first]], "best": [words[i] for i in other[first]],
    }


def _compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, half, low, high, side, word, n) sorted by all of them but side and n."""

    def whole_groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
        kind, half, low, high, side, n = (
            table.column(c).to_numpy() for c in ("kind", "half", "low", "high", "side", "n")
        )
        words = table.column("word").to_pylist()
        new = np.r_[True, np.any([c[1:] != c[:-1] for c in (kind, half, low, high)], axis=0)]
        begins = np.append(np.flatnonzero(new), len(words))
        at = 0
        while at < len(begins) - 1:  # as many groups of one kind as a matrix may hold
            most = begins[at] + max(1, CELLS // max(1, kind[begins[at]] // 2))
            to = int(np.searchsorted(begins, min(most, begins[-1]), "right")) - 1
            to = max(at + 1, to)
            same = np.flatnonzero(kind[begins[at:to]] != kind[begins[at]])
            to = at + int(same[0]) if len(same) else to
            part = slice(begins[at], begins[to])
            own = words[part]
            x, y = neighbours(
                own, int(kind[begins[at]]), begins[at:to] - begins[at], (low != high)[part], side[part]
            )
            if len(x):
                yield from batches([_partial(own, n[part], x, y)], NEAR)
            at = to

    pending = None
    for batch in rows:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if pending is None else pa.concat_tables([pending, table])
        last = [table.column(c)[-1] for c in ("kind", "half", "low", "high")]
        same = np.all([
            table.column(c).to_numpy() == v.as_py()
            for c, v in zip(("kind", "half", "low", "high"), last, strict=True)
        ], axis=0)
        begin = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if begin:
            yield from whole_groups(table.slice(0, begin))
        pending = table.slice(begin)
    if pending is not None:
        yield from whole_groups(pending)


def near_words(words: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n; no repeats) with a near word; best is
    the near word of largest n, ties go to the smallest in code-point order."""
    index = words.select("word", "n", F.explode(_halves(F.col("word"))).alias("at")).select("at.*", "word", "n")
    rows_of = F.greatest(F.lit(1), F.least(F.lit(tile_rows), F.floor(F.lit(2 * CELLS) / F.col("kind"))))
    crowded = index.groupBy("kind", "half").agg(F.count(F.lit(1)).alias("size")).where(
        F.col("size") > rows_of
    ).select("kind", "half", F.ceil(F.col("size") / rows_of).cast("int").alias("tiles"))
    crowded = stored(crowded, "spelling-crowded")
    tiles = F.coalesce("tiles", F.lit(1))
    placed = index.join(crowded, ["kind", "half"], "left").withColumn(
        "side", F.pmod(F.xxhash64("word"), tiles).cast("int")
    )
    met = F.transform(F.sequence(F.lit(0), tiles - 1), lambda j: F.struct(
        F.least("side", j).alias("low"), F.greatest("side", j).alias("high"),
    ))
    group = ["kind", "half", "low", "high"]
    dealt = (
        placed.select("kind", "half", "side", "word", "n", F.explode(met).alias("met"))
        .select("kind", "half", "met.*", "side", "word", "n")
        .repartition(*group).sortWithinPartitions(*group, "word")
    )
    found = dealt.mapInArrow(_compare, "word string, near long, best_n long, best string")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"),
    ).select("word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best")


def roots_of(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, chains of up to ``steps``."""
    forms = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(1, steps)))):
        ahead = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        forms = stored(
            forms.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "spelling-roots",
        )
    return forms


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, ratio: int = RATIO, altered_every: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Every word of ``least_length`` code points or more that occurs ``least_count`` times or more.

    Columns: word, form (the near word of largest n, ties to the smallest in code-point order, if
    that n is ``ratio`` times the word's or more; else null), root (forms followed to the last; the
    word itself without one), n, n_near (words exactly one edit apart, 0 if none), form_n. What a word
    is and what ``altered_every`` does, ``word_counts`` says. Null and empty texts have no words;
    repeated rows count each; words of any length are compared whole. An empty table gives no rows;
    other columns are not read.
    """
    words = stored(
        word_counts(docs, key, text, least_length, altered_every).where(F.col("n") >= least_count),
        "spelling-words",
    )
    near = near_words(words, tile_rows)
    good = F.col("best_n") >= ratio * F.col("n")
    known = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"),
    ), "spelling-forms")
    # n grows by the ratio with every step, so the largest one bounds the length of a chain
    most = words.agg(F.max("n")).first()[0] or 1
    steps = 1
    while ratio > 1 and ratio ** steps <= most:
        steps += 1
    roots = roots_of(known.where("form IS NOT NULL"), steps)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
