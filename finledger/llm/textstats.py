"""Statistics of whole texts, one pass per text, as columns that rules and classifiers read."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.llm.common import batches, texts_of

# Fixed values of the contract: the characters that count as symbols, and those between words.
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 3

_STARTS = np.array([b & 0xC0 != 0x80 for b in range(256)])  # bytes that begin a code point
_BLANK = np.array([b in BLANKS for b in range(256)])
_CLASSES = {
    "n_symbols": SYMBOLS, "n_digits": b"0123456789", "n_upper": bytes(range(65, 91)),
    "n_lower": bytes(range(97, 123)), "n_marks": b"!?", "n_stops": b".,;:",
}
_CLASS_ROWS = np.array([[b in chars for b in range(256)] for chars in _CLASSES.values()])

NAMES = (
    "n_words", "word_chars", *_CLASSES, "n_wide", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_top_word",
)
STATS = pa.schema([("key", pa.int64()), *[(n, pa.int64()) for n in NAMES]])


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words in windows of three that the text holds twice or more, the first one included."""
    if len(ids) < WINDOW + 1:
        return 0
    if kinds < 1 << 21:
        windows = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    else:  # too many kinds for one number: name the pairs first
        _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
        windows = pairs[:-1] * kinds + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(WINDOW):
        covered[k:k + len(windows)] |= twice
    return int(covered.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The statistics in the order of ``NAMES``."""
    octets = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    points = int(octets[_STARTS].sum())
    classes = (_CLASS_ROWS @ octets).tolist()
    words = text.split()
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    top = int(np.bincount(ids).max()) if words else 0
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return (
        len(words), points - int(octets[_BLANK].sum()), *classes, int(octets[192:].sum()),
        len(lines), len(lines) - len(set(lines)), repeated_words(ids, len(names)), len(names), top,
    )


def text_statistics(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: str | None = None
) -> DataFrame:
    """The key (bigint) as ``key``, a bigint per statistic, and the string column ``carry`` of
    the same row; a null text counts as empty."""
    schema = STATS.append(pa.field(carry, pa.string())) if carry else STATS

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [statistics(t) for t in texts_of(batch, "text")]
            columns = dict(zip(NAMES, zip(*found, strict=True) if found else [[]] * len(NAMES),
                               strict=True))
            columns["key"] = batch.column(0)
            if carry:
                columns[carry] = batch.column(2)
            yield from batches([columns], schema)

    rows = docs.selectExpr(
        f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text", *([f"`{carry}`"] if carry else [])
    )
    kinds = [f"{f.name} long" for f in STATS] + ([f"{carry} string"] if carry else [])
    return rows.mapInArrow(run, ", ".join(kinds))


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    """Every row whole, as the struct ``__row`` (so no names can clash), beside its statistics."""
    row = T.StructField("__row", T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
    stats = [T.StructField(n, T.LongType()) for n in NAMES]
    at = docs.columns.index(text)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            whole = batch.column(0)
            texts = pc.struct_field(whole, [at]).cast(pa.large_binary()).to_pylist()
            found = [statistics(t or b"") for t in texts]
            columns = zip(*found, strict=True) if found else [[]] * len(NAMES)
            yield pa.RecordBatch.from_arrays(
                [whole, *[pa.array(c, pa.int64()) for c in columns]], names=["__row", *NAMES]
            )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return rows.mapInArrow(run, T.StructType([row, *stats]))


# Shares of the statistics, as SQL over the columns above; empty texts divide by one.
RATIOS = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "stops_per_word": "n_stops / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "letter_share": "(n_lower + n_upper + n_wide) / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "top_word_share": "n_top_word / greatest(n_words, 1)",
    "log_words": "ln(n_words + 1)",
}
