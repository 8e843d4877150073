"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints link at up to four differing bits. Cut into three segments, two linked ones differ
by at most one bit in some segment (four bits cannot put two into each of three). A segment is
indexed under each of its one-wildcard variants, the segment with one bit masked out: two
segments that differ in that bit, or nowhere, meet under it. Members of a bucket are verified
on all 64 bits, in blocks, and hand on a spanning forest instead of all pairs.

Copies share a fingerprint and are indexed once. A bucket of more than ``HOT`` different
fingerprints is not compared inside: its members are joined by *midpoints* instead. Fingerprints
within four bits have a common point within two bits of both, and all that have such a point in
common are within four bits of each other, so each point links its members to their smallest one:
exact, with a fixed count of rows per member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import batches, stored, texts_of
from finledger.llm.components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
CUTS = (0, 22, 43, 64)
HOT = 1024
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
COLUMNS = np.arange(8, dtype=np.int64) * 256


def hashes(text: bytes) -> np.ndarray:
    """XXH64 of every shingle of four words, repeats included."""
    words = text.translate(LOWER).split()
    if len(words) < SHINGLE:
        spans = [b" ".join(words)] if words else []
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        begins = (ends - sizes)[:1 - SHINGLE].tolist()
        spans = [joined[a:b] for a, b in zip(begins, (ends[SHINGLE - 1:] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(s, SEED) for s in spans]), dtype=">u8")


def fingerprint(text: bytes) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit number; 0 without a word."""
    found = hashes(text).astype("<u8")
    if not len(found):
        return 0
    votes = np.zeros((8, 256), dtype=np.int64)
    for a in range(0, len(found), 1 << 18):
        octets = found[a:a + (1 << 18)].view(np.uint8).reshape(-1, 8)
        votes += np.bincount((octets + COLUMNS).ravel(), minlength=2048).reshape(8, 256)
    bits = (votes @ BITS.astype(np.int64)).ravel() * 2 > len(found)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


FINGERPRINTS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of every whole text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield from batches(
                [{"key": batch.column(0), "fp": [fingerprint(t) for t in texts_of(batch, "text")]}],
                FINGERPRINTS,
            )

    rows = docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS key", f"`{text}` AS text")
    return rows.mapInArrow(run, "key long, fp long")


def variants(fp: Column) -> Column:
    """The 64 one-wildcard variants of the three segments: masked segment and its number."""
    out = []
    for begin, end in zip(CUTS, CUTS[1:], strict=False):
        mask = (1 << (end - begin)) - 1
        segment = F.shiftrightunsigned(fp, begin).bitwiseAND(F.lit(mask))
        out += [
            F.shiftleft(segment.bitwiseAND(F.lit(mask & ~(1 << bit))), 6) + F.lit(begin + bit)
            for bit in range(end - begin)
        ]
    return F.array(*out)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what the given links connect, one per node at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    hangs = root != np.arange(len(nodes))
    return nodes[hangs], nodes[root[hangs]]


def linked(variant: np.ndarray, bucket: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of neighbouring rows of the same bucket, rows sorted by bucket.

    A pair counts in the bucket of the bit in which its segment differs; one with equal
    segments only in that of the segment's first bit.
    """
    begins = np.array(CUTS[:-1])
    segment = np.searchsorted(begins, variant, side="right") - 1
    first = begins[segment].astype(np.uint64)
    mask = ((np.uint64(1) << (np.array(CUTS[1:])[segment] - begins[segment]).astype(np.uint64))
            - np.uint64(1))
    own = np.uint64(1) << (variant.astype(np.uint64) - first)
    a_out, b_out = [], []
    rows = np.arange(len(fps))
    step = 1
    while len(rows):
        rows = rows[rows + step < len(fps)]
        rows = rows[bucket[rows] == bucket[rows + step]]
        differs = fps[rows] ^ fps[rows + step]
        inside = (differs >> first[rows]) & mask[rows]
        here = (inside == own[rows]) | ((inside == 0) & (own[rows] == 1))
        good = rows[here & (np.bitwise_count(differs) <= DISTANCE)]
        a_out.append(fps[good])
        b_out.append(fps[good + step])
        step += 1
    return np.concatenate(a_out or [fps[:0]]), np.concatenate(b_out or [fps[:0]])


def _compare(hot: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links inside buckets of up to ``hot`` rows, from rows (bucket, fp) sorted by bucket; members of
    larger ones come back as (fp, null). Of a bucket no more than ``hot`` rows are held."""

    def inside(bucket: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(fps):
            return
        new = np.r_[True, bucket[1:] != bucket[:-1]]
        number = np.cumsum(new) - 1
        large = (np.bincount(number) > hot)[number]
        yield from crowded(fps[large])
        a, b = linked(bucket[~large] & 63, number[~large], fps[~large])
        node, root = forest(a, b)
        yield from batches([{"a": node.view(np.int64), "b": root.view(np.int64)}], LINKS)

    def crowded(fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fps):
            yield from batches([{"a": fps.view(np.int64), "b": [None] * len(fps)}], LINKS)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        over = None  # the bucket whose rows are handed on as they come
        for batch in rows:
            bucket, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if over is not None:
                go_on = int(np.searchsorted(bucket, over, "right"))
                yield from crowded(fps[:go_on])
                bucket, fps = bucket[go_on:], fps[go_on:]
            if not len(fps):
                continue
            over = None
            bucket, fps = (np.concatenate(p) for p in zip(held, (bucket, fps), strict=True))
            last = int(np.searchsorted(bucket, bucket[-1]))
            yield from inside(bucket[:last], fps[:last])
            held = (bucket[last:], fps[last:])
            if len(held[0]) > hot:
                over = held[0][0]
                yield from crowded(held[1])
                held = (held[0][:0], held[1][:0])
        yield from inside(*held)

    return run


_FLIPS = np.array(
    [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)],
    dtype=np.uint64,
)


def _midpoints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for fp in batch.column(0).to_numpy().view(np.uint64):
            points = (_FLIPS ^ fp).view(np.int64)
            yield from batches([{"a": points, "b": np.full(len(points), fp).view(np.int64)}], LINKS)


def link_fingerprints(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) links that connect fingerprints (column fp, no repeats) within four bits.

    Buckets are sorted and streamed through a task, so none is ever gathered.
    """
    # few bytes become 64 rows each, so they are dealt out first
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = distinct.repartition(parts, "fp").select(
        F.explode(variants(F.col("fp"))).alias("bucket"), "fp"
    )
    found = stored(
        index.repartition("bucket").sortWithinPartitions("bucket", "fp")
        .mapInArrow(_compare(hot), "a long, b long"),
        "simhash-links",
    )
    crowd = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    points = crowd.mapInArrow(_midpoints, "a long, b long")
    least = points.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
    joined = (
        points.join(least.where("n > 1"), "a").where("b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return found.where("b IS NOT NULL").union(joined)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT
) -> DataFrame:
    """Every document with its fingerprint and component.

    Columns: the key, fingerprint (16 lowercase hex digits), component_id (smallest key
    reachable over links of up to four bits, itself included). Texts without a word (null, empty,
    blank) have fingerprint zero and are linked like any other. Rows that share a key are
    fingerprinted each; a null key takes part and is never the smallest; where a component has only
    null keys its id is null. An empty table gives no rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, key, text), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min("key").alias("least")), "simhash-groups")
    hung = components(link_fingerprints(groups.select("fp"), hot), "a", "b")
    roots = groups.join(hung, groups["fp"] == hung["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = roots.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest key, all columns kept.

    A key stays if any of its rows is its group's first; rows with a null key stay.
    """
    found = near_duplicates(docs, key, text)
    gone = (
        found.groupBy(key).agg(F.max(F.col(key) == F.col("component_id")).alias("__first"))
        .where("NOT __first").select(key)
    )
    gone = gone.select(F.col(key).alias("__gone"))
    return docs.join(gone, docs[f"`{key}`"] == gone["__gone"], "left_anti")
