"""Hard negatives by threshold joins (L2AP: Anastasiu and Karypis, 2014).

An anchor's positives are its nearest rows of the same label, and a positive's hard negatives are
the best rows of other labels whose score lies in a window below the positive's. Both are threshold
joins that start high and are lowered until enough rows are found.

Rows are dealt into shards and anchors into blocks, both of bounded size; every block meets every
shard in a task, and what a task returns per anchor is bounded, too. In a task the shard's rows
are indexed by dimension. By Cauchy and Schwarz the leading dimensions of a row, as long as their
norm times the largest anchor's stays below the threshold, can't lift a pair over it alone, so they
are left out of the index. Scores are accumulated from the last dimensions on; after each step
pairs whose score so far plus the product of the remaining norms stays below the threshold go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finledger.llm.common import stored

SCALE = 256
EVERY = 100  # anchors are the rows whose id is divisible by this
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH, OF = 80, 100, 100  # window of a negative's score, in shares of the positive's
SHARD_ROWS = 4096
BLOCK_ANCHORS = 1024
ANCHORS_AT_ONCE = 128  # anchors of a block that are worked on together, for the memory's sake
STEP = 8  # dimensions accumulated between two looks at the bounds
EXACT = 2.0**46  # up to here doubles are exact, a hundredfold score included
MOST = 2**63 - 1
POSITIVE_LEVELS = (0.9, 0.7, 0.5, 0.3, 0.1)  # of the product of norms, then everything
NEGATIVE_LEVELS = (1.0, 0.95, 0.9, 0.85)  # of the smallest positive's score, then the window's end

FOUND = pa.schema([
    ("a_id", pa.int64()), ("a_sum", pa.int64()), ("b_id", pa.int64()), ("b_sum", pa.int64()),
    ("score", pa.int64()),
])
TRIPLES = pa.schema([
    ("a_id", pa.int64()), ("a_sum", pa.int64()), ("p_id", pa.int64()), ("p_sum", pa.int64()),
    ("p_score", pa.int64()), ("b_id", pa.int64()), ("b_sum", pa.int64()), ("score", pa.int64()),
])


def _kinds(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Scaled components as whole doubles, a row per vector, shorter ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.nan_to_num(np.floor(SCALE * flat))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def together(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(q.shape[1], x.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))


class Rows:
    """A shard's rows with their norms over leading dimensions."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.lead = np.sqrt(np.concatenate(
            [np.zeros((len(x), 1)), np.cumsum(x * x, axis=1)], axis=1
        ))
        self.norm = self.lead[:, -1]

    def at_least(
        self, q: np.ndarray, least: np.ndarray, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all allowed pairs that score ``least[anchor]`` or more, exactly.

        A hair is left on every bound for the rounding of the norms; scores are whole numbers.
        """
        hair = 1 + 1e-9
        q_lead = np.sqrt(np.concatenate([np.zeros((len(q), 1)), np.cumsum(q * q, axis=1)], axis=1))
        width, most = q.shape[1], q_lead[:, -1].max(initial=0.0)
        floor = least.min(initial=np.inf)
        # leading dimensions of each row that stay out of the index; all: no pair can reach it
        out = (self.lead * most * hair < floor).sum(axis=1) - 1
        rows = np.flatnonzero(out < width)
        rows = rows[np.argsort(out[rows], kind="stable")]
        out, x, lead = np.maximum(out[rows], 0), self.x[rows], self.lead[rows]
        score = np.zeros((len(q), len(rows)))
        for end in range(width, 0, -STEP):
            begin = max(0, end - STEP)
            n = int(np.searchsorted(out, end))  # rows with postings in these dimensions come first
            if not n:
                break
            posted = x[:n, begin:end] * (np.arange(begin, end) >= out[:n, None])
            score[:, :n] += q[:, begin:end] @ posted.T
            at = np.maximum(out, begin)  # dimensions in front of it are still to come
            best = score + q_lead[:, at] * (lead[np.arange(len(rows)), at] * hair)
            some = (best >= least[:, None]).any(axis=0)
            if not some.all():
                rows, out, x, lead, score = rows[some], out[some], x[some], lead[some], score[:, some]
        best = score + q_lead[:, out] * (lead[np.arange(len(rows)), out] * hair)
        a, r = np.nonzero(best >= least[:, None])
        good = allowed(a, rows[r])
        a, r = a[good], r[good]
        value = np.empty(len(a))  # with what the index left out
        for s in range(0, len(a), 1 << 16):
            part = slice(s, s + (1 << 16))
            value[part] = np.einsum("ij,ij->i", q[a[part]], x[r[part]])
        good = value >= least[a]
        return a[good], rows[r[good]], value[good]


def all_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray | None:
    """Whole scores as Python integers where doubles would round, kept within 64 bits; else None."""
    top = max(float(np.abs(m).max(initial=0.0)) for m in (q, x))
    if top * top * max(1, q.shape[1]) < EXACT:
        return None
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object) for m in (q, x)]
    return np.clip(whole[0] @ whole[1].T, -MOST, MOST).astype(np.int64)


def first_of(
    anchor: np.ndarray, ids: np.ndarray, sums: np.ndarray, score: np.ndarray, most: int
) -> np.ndarray:
    """Places of the best ``most`` entries of each anchor: higher scores, then smaller ids."""
    order = np.lexsort((sums, ids, -score, anchor))
    group = anchor[order]
    begin = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(begin, np.arange(len(group)), 0))
    return order[place < most]


def best_positives(
    q: np.ndarray, q_label: np.ndarray, x: np.ndarray, x_label: np.ndarray, ids: np.ndarray,
    sums: np.ndarray, own: Callable[[np.ndarray, np.ndarray], np.ndarray], most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's best rows of its label, itself left out."""

    def allowed(a: np.ndarray, r: np.ndarray) -> np.ndarray:
        return (q_label[a] == x_label[r]) & ~own(a, r)

    whole = all_scores(q, x)
    if whole is not None:
        a, r = np.nonzero(allowed(*np.indices(whole.shape)))
        s = whole[a, r]
        keep = first_of(a, ids[r], sums[r], s, most)
        return a[keep], r[keep], s[keep]
    rows = Rows(x)
    high = np.sqrt((q * q).sum(axis=1)) * rows.norm.max(initial=0.0)
    parts = []
    for begin in range(0, len(q), ANCHORS_AT_ONCE):
        todo = np.arange(begin, min(len(q), begin + ANCHORS_AT_ONCE))
        for level in (*POSITIVE_LEVELS, None):
            least = np.full(len(todo), -np.inf) if level is None else high[todo] * level
            a, r, s = rows.at_least(q[todo], least, lambda a, r, todo=todo: allowed(todo[a], r))
            done = (np.bincount(a, minlength=len(todo)) >= most) | (level is None)
            a, r, s = todo[a[done[a]]], r[done[a]], s[done[a]]
            keep = first_of(a, ids[r], sums[r], s, most)
            parts.append((a[keep], r[keep], s[keep]))
            todo = todo[~done]
            if not len(todo):
                break
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def window_negatives(
    q: np.ndarray, q_label: np.ndarray, x: np.ndarray, x_label: np.ndarray, ids: np.ndarray,
    sums: np.ndarray, anchor: np.ndarray, positive_score: np.ndarray, most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positive, row, score): the best rows of other labels in the window of each positive.

    ``anchor`` and ``positive_score`` have an entry per positive. Thresholds start at an anchor's
    lowest positive and sink until each of its windows holds enough rows or is read to its end.
    """

    def allowed(a: np.ndarray, r: np.ndarray) -> np.ndarray:
        return q_label[a] != x_label[r]

    out: list[tuple] = []

    def take(windows: np.ndarray, a: np.ndarray, r: np.ndarray, s: np.ndarray, kind: type) -> np.ndarray:
        """Best rows of these windows into ``out``; how many each one has."""
        count = np.zeros(len(windows), np.int64)
        order = np.argsort(a, kind="stable")
        a, r, s = a[order], r[order], s[order]
        begins, ends = np.searchsorted(a, anchor[windows]), np.searchsorted(a, anchor[windows], "right")
        for at, (w, begin, end) in enumerate(zip(windows.tolist(), begins, ends, strict=True)):
            of, top = OF * s[begin:end].astype(kind), positive_score[w].item()
            mine = begin + np.flatnonzero((of <= HIGH * top) & (of >= LOW * top))
            mine = mine[first_of(np.zeros(len(mine), np.int64), ids[r[mine]], sums[r[mine]], s[mine], most)]
            count[at] = len(mine)
            out.append((np.full(len(mine), w), r[mine], s[mine]))
        return count

    windows = np.flatnonzero(positive_score >= 0)  # below zero a window's ends cross
    whole = all_scores(q, x)
    if whole is not None:
        a, r = np.nonzero(allowed(*np.indices(whole.shape)))
        take(windows, a, r, whole[a, r], object)
        windows = windows[:0]
    rows = Rows(x)
    for begin in range(0, len(q), ANCHORS_AT_ONCE):
        todo = windows[(anchor[windows] >= begin) & (anchor[windows] < begin + ANCHORS_AT_ONCE)]
        for level in (*NEGATIVE_LEVELS, None):
            if not len(todo):
                break
            mine, at = np.unique(anchor[todo], return_inverse=True)
            lowest = np.full(len(mine), np.inf)
            np.minimum.at(lowest, at, positive_score[todo].astype(np.float64))
            least = np.ceil(LOW * lowest / OF)  # scores are whole: this is where windows end
            if level is not None:
                least = np.maximum(np.ceil(level * lowest), least)
            a, r, s = rows.at_least(q[mine], least, lambda a, r, mine=mine: allowed(mine[a], r))
            before = len(out)
            count = take(todo, mine[a], r, s, float)
            done = (count >= most) | (OF * least[at] <= LOW * positive_score[todo]) | (level is None)
            out[before:] = [o for o, d in zip(out[before:], done, strict=True) if d]
            todo = todo[~done]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _positives(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return FOUND.empty_table()
        q, x = together(matrix(anchors.column("vec")), matrix(rows.column("vec")))
        a_id, a_sum, a_label = _columns(anchors, "id", "sum", "label")
        ids, sums, labels = _columns(rows, "id", "sum", "label")
        a, r, s = best_positives(
            q, a_label, x, labels, ids, sums,
            lambda a, r: (a_id[a] == ids[r]) & (a_sum[a] == sums[r]), most,
        )
        return pa.table([a_id[a], a_sum[a], ids[r], sums[r], pa.array(s.astype(np.int64))], schema=FOUND)

    return run


def _negatives(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return TRIPLES.empty_table()
        q, x = together(matrix(anchors.column("vec")), matrix(rows.column("vec")))
        a_id, a_sum, a_label = _columns(anchors, "id", "sum", "label")
        ids, sums, labels = _columns(rows, "id", "sum", "label")
        lists = anchors.column("positives").combine_chunks()
        anchor = np.repeat(np.arange(anchors.num_rows), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        p_id, p_sum, p_score = (flat.field(n).to_numpy() for n in ("id", "sum", "score"))
        w, r, s = window_negatives(
            q, a_label, x, labels, ids, sums, anchor, p_score, most,
        )
        return pa.table([
            a_id[anchor[w]], a_sum[anchor[w]], p_id[w], p_sum[w], p_score[w], ids[r], sums[r],
            pa.array(s.astype(np.int64)),
        ], schema=TRIPLES)

    return run


def usable(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, vec, sum) of the rows that take part; sum tells rows of one id apart."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    rows = rows.select(
        F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        vec.alias("vec"),
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite)
    return rows.withColumn("sum", F.xxhash64("id", "label", "vec"))


def _dealt(what: Column, most: Column | int) -> Column:
    """Number of the shard (or block) that a row of this hash goes to."""
    return F.pmod(F.xxhash64(what, F.lit(1)), F.lit(most) if isinstance(most, int) else most).cast("int")


def mine(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Hard negatives of each anchor's positives.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score (all long
    but rank). Components count as floor(256 * x), the score of two rows is the inner product; higher
    scores come first, then smaller ids. Rows with a null id, a null label, a null vector, or a null
    or non-finite component take no part. Vectors of different length are filled with zeros, an
    empty one scores zero. Rows alike in id, label and vector are one row; rows that share only an
    id are different ones (an anchor of theirs has results of its own). Scores beyond 64 bits count
    as the largest number there is. An anchor without another row of its label, or a window without
    rows, gives no rows; neither does an empty table. Other columns are not read.
    """
    known = stored(usable(rows, key, vector, label).dropDuplicates(["id", "sum"]), "mining-rows")
    sizes = known.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("id") % every == 0).cast("bigint")).alias("anchors"),
    )
    sizes = stored(sizes.where("anchors > 0"), "mining-labels")
    asked = sizes.agg(F.sum("anchors")).first()[0] or 0
    shards, blocks = max(1, -(-known.count() // shard_rows)), max(1, -(-asked // block_anchors))

    # rows of a label meet its anchors; a label of any size is dealt into shards and blocks
    parts = sizes.select(
        "label", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"),
        F.ceil(F.col("anchors") / block_anchors).cast("int").alias("blocks"),
    )
    same = known.join(parts, "label")
    group, own = ["label", "shard", "block"], ["id", "sum", "vec"]
    hunted = same.withColumn("shard", _dealt(F.col("sum"), F.col("shards"))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    asking = same.where(F.col("id") % every == 0).withColumn(
        "block", _dealt(F.col("sum"), F.col("blocks"))
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    found = (
        asking.select(*group, *own).toDF(*group, *own).groupBy(*group)
        .cogroup(hunted.select(*group, *own).groupBy(*group))
        .applyInArrow(_positives(positives), _kinds(FOUND))
    )
    place = Window.partitionBy("a_id", "a_sum").orderBy(F.desc("score"), "b_id", "b_sum")
    found = stored(
        found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= positives)
        .groupBy("a_id", "a_sum").agg(F.collect_list(F.struct(
            F.col("b_id").alias("id"), F.col("b_sum").alias("sum"), "score",
        )).alias("positives")),
        "mining-positives",
    )

    group, own = ["shard", "block"], ["id", "sum", "label", "vec"]
    asking = known.join(found, (F.col("id") == F.col("a_id")) & (F.col("sum") == F.col("a_sum")))
    asking = asking.withColumn("block", _dealt(F.col("sum"), blocks)).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    hunted = known.withColumn("shard", _dealt(F.col("sum"), shards)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    triples = (
        asking.select(*group, *own, "positives").toDF(*group, *own, "positives").groupBy(*group)
        .cogroup(hunted.select(*group, *own).groupBy(*group))
        .applyInArrow(_negatives(negatives), _kinds(TRIPLES))
    )
    place = Window.partitionBy("a_id", "a_sum", "p_id", "p_sum").orderBy(F.desc("score"), "b_id", "b_sum")
    return triples.withColumn("rank", F.row_number().over(place)).where(
        F.col("rank") <= negatives
    ).select(
        F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank",
        F.col("b_id").alias("negative_id"), F.col("p_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
