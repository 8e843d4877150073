"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Vectors are dealt to shards of a bounded size; each shard builds its graph in one task, adding
vectors in batches (the graph on the top layers is a prefix of the vectors, so a layer is an
array). Then the vectors of every shard query every shard: a task holds the graphs of two shards
and asks both ways, so a link found from either side counts at both. Queries walk in step: each
keeps a beam of the best vectors seen, expands its best unexpanded ones, and ends when all in
the beam are expanded. A query whose beam is full of hits gets a wider one, and an audit against brute force
on some queries of the task widens all beams until it is passed. Hits are verified in double
precision.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import mix, stored
from finledger.llm.components import components
from finledger.llm.simhash import forest

COSINE = 0.9
SHARD_ROWS = 1 << 16  # vectors of one graph: a task marks the links between two in 512 MB of bits
DEGREE = 16  # links of a vector in upper layers, twice as many in the lowest
BEAM = 64
RECALL = 0.99  # of the links that the audited queries have
AUDITED = 64  # queries with a link that an audit looks for among 16 times as many
SLACK = 1e-3  # a beam is full of hits while its last is no further than this below the threshold
_STEP = 4  # vectors that a query expands at once
_ROWS = 64  # rows of bits that are read at once
_TIED = 1 << 20  # pairs that are gathered before they are reduced to few links
_WHOLE = 8  # a widened beam of an eighth of the graph costs more than reading all of it
_QUERIES = 512  # queries that walk in step; each marks what it has seen in a row of bytes


class Graph:
    """Vectors in the order of their layers, highest first, and the links of each layer."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray,
                 layers: list[np.ndarray]):
        self.ids, self.vectors, self.copies, self.layers = ids, vectors, copies, layers
        self.unit = unit(vectors).astype(np.float32)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, copies=self.copies,
                 **{f"layer{i}": x for i, x in enumerate(self.layers)})
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Graph:
        with np.load(io.BytesIO(data)) as z:
            layers = [z[f"layer{i}"] for i in range(len(z.files) - 3)]
            return Graph(z["ids"], z["vectors"], z["copies"], layers)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so nothing overflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("nd,nd->n", v, v))[:, None]


def walk(
    unit_: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(positions, similarities) of each query's beam, best first; -1 where it is not full.

    ``starts`` has positions for each query, -1 for none.
    """
    outs = [_walk(unit_, links, queries[a:a + _QUERIES], starts[a:a + _QUERIES], beam)
            for a in range(0, len(queries), _QUERIES)]
    return np.concatenate([o[0] for o in outs]), np.concatenate([o[1] for o in outs])


def _similar(unit_: np.ndarray, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
    found = np.einsum("qcd,qd->qc", unit_[np.maximum(at, 0)], queries, optimize=True)
    return np.where(at >= 0, found, -np.inf).astype(np.float32)


def _once(at: np.ndarray) -> np.ndarray:
    """Repeats within a row become -1."""
    at = np.sort(at, axis=1)
    at[:, 1:][at[:, 1:] == at[:, :-1]] = -1
    return at


def _walk(unit_, links, queries, starts, beam):
    n, q = len(links), len(queries)
    seen = np.zeros((q, n), dtype=bool)
    rows = np.arange(q)[:, None]
    at = _once(starts.copy())
    seen[np.broadcast_to(rows, at.shape)[at >= 0], at[at >= 0]] = True
    best = np.full((q, beam), -1, dtype=np.int64)
    sims = np.full((q, beam), -np.inf, dtype=np.float32)
    done = np.ones((q, beam), dtype=bool)
    active = np.arange(q)
    new_sims = _similar(unit_, at, queries)
    while len(active):
        all_at = np.concatenate([best[active], at], axis=1)
        all_sims = np.concatenate([sims[active], new_sims], axis=1)
        all_done = np.concatenate([done[active], at < 0], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        best[active] = np.take_along_axis(all_at, order, 1)
        sims[active] = np.take_along_axis(all_sims, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1) | (best[active] < 0)
        active = active[~done[active].all(axis=1)]
        if not len(active):
            break
        # the first unexpanded ones of each beam
        todo = ~done[active]
        pick = todo & (np.cumsum(todo, axis=1) <= _STEP)
        done[active] |= pick
        nth = np.where(pick, np.cumsum(pick, axis=1) - 1, _STEP)
        chosen = np.full((len(active), _STEP + 1), -1, dtype=np.int64)
        np.put_along_axis(chosen, nth, best[active], axis=1)
        chosen = chosen[:, :_STEP]
        near = np.where(chosen[:, :, None] >= 0, links[np.maximum(chosen, 0)], -1)
        at = _once(near.reshape(len(active), -1).astype(np.int64))
        owner = np.broadcast_to(active[:, None], at.shape)
        at[(at >= 0) & seen[owner, np.maximum(at, 0)]] = -1
        seen[owner[at >= 0], at[at >= 0]] = True
        width = max(1, int((at >= 0).sum(axis=1).max()))
        at = -np.sort(-at, axis=1)[:, :width]  # what is left, to the front
        new_sims = _similar(unit_, at, queries[active])
    return best, sims


def diverse(
    unit_: np.ndarray, at: np.ndarray, sims: np.ndarray, degree: int
) -> np.ndarray:
    """Of each row's candidates (best first, -1 for none) up to ``degree``: those nearer to the
    row's vector than to any taken before them, then the best of the rest."""
    out = []
    for a in range(0, len(at), 256):
        part, own = at[a:a + 256], sims[a:a + 256]
        vectors = unit_[np.maximum(part, 0)]
        cross = np.einsum("qcd,qed->qce", vectors, vectors, optimize=True)
        taken = np.zeros(part.shape, dtype=bool)
        closest = np.full(part.shape, -np.inf, dtype=np.float32)
        for c in range(part.shape[1]):
            good = (part[:, c] >= 0) & (own[:, c] > closest[:, c]) & (taken.sum(axis=1) < degree)
            taken[good, c] = True
            closest[good] = np.maximum(closest[good], cross[good, c])
        rank = np.where(part < 0, 2, np.where(taken, 0, 1))
        order = np.argsort(
            rank * 4.0 - np.where(part < 0, 0, own), axis=1, kind="stable"
        )[:, :degree]
        picked = np.take_along_axis(part, order, 1)
        if picked.shape[1] < degree:
            picked = np.pad(picked, ((0, 0), (0, degree - picked.shape[1])), constant_values=-1)
        out.append(picked)
    return np.concatenate(out)


def _back(unit_, links, begin, end, picked):
    """Links back from the neighbours of new vectors; a full list keeps its most diverse."""
    degree = links.shape[1]
    new = np.repeat(np.arange(begin, end), picked.shape[1])
    old = picked.ravel()
    new, old = new[old >= 0], old[old >= 0]
    if not len(new):
        return
    sims = np.einsum("nd,nd->n", unit_[new], unit_[old])
    order = np.lexsort((-sims, old))
    new, old, sims = new[order], old[order], sims[order]
    nodes, first, counts = np.unique(old, return_index=True, return_counts=True)
    rank = np.arange(len(old)) - np.repeat(first, counts)
    few = rank < degree
    extra = np.full((len(nodes), degree), -1, dtype=np.int64)
    extra[np.repeat(np.arange(len(nodes)), counts)[few], rank[few]] = new[few]
    room = (links[nodes] < 0).sum(axis=1) >= np.minimum(counts, degree)
    for node, adds in zip(nodes[room], extra[room], strict=True):
        adds = adds[adds >= 0]
        links[node, np.flatnonzero(links[node] < 0)[:len(adds)]] = adds
    nodes, extra = nodes[~room], extra[~room]
    for a in range(0, len(nodes), 1024):
        own = nodes[a:a + 1024]
        at = _once(np.concatenate([links[own], extra[a:a + 1024]], axis=1))
        near = _similar(unit_, at, unit_[own])
        order = np.argsort(-near, axis=1, kind="stable")
        links[own] = diverse(
            unit_, np.take_along_axis(at, order, 1), np.take_along_axis(near, order, 1), degree
        )


def _descend(unit_, layers, queries, width):
    """Start positions for the layer below ``layers`` (the lowest one first in the list)."""
    starts = np.zeros((len(queries), 1), dtype=np.int64)
    for links in reversed(layers):
        starts, _ = walk(unit_[:len(links)], links, queries, starts, width)
    return starts


def build(ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray,
          seeds: np.ndarray | None = None, degree: int = DEGREE, beam: int = BEAM) -> Graph:
    """A graph over distinct non-zero vectors. A vector's highest layer comes from its seed (its
    id where none is given), so the graph does not depend on the order of rows."""
    seeds = ids if seeds is None else seeds
    mixed = mix(~seeds.astype(np.int64).view(np.uint64))
    chance = ((mixed >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    most = math.ceil(math.log(len(ids) + 1) / math.log(degree))
    level = np.minimum(np.floor(-np.log(chance) / math.log(degree)), most).astype(np.int64)
    order = np.lexsort((seeds, -level))
    ids, vectors, copies, level = ids[order], vectors[order], copies[order], level[order]
    unit_ = unit(vectors).astype(np.float32)
    layers: list[np.ndarray] = []  # the lowest so far first
    for height in range(int(level.max()), -1, -1):
        size, width = int((level >= height).sum()), degree * (1 if height else 2)
        links = np.full((size, width), -1, dtype=np.int64)
        at = min(size, 256)
        near = unit_[:at] @ unit_[:at].T
        np.fill_diagonal(near, -np.inf)
        best = np.argsort(-near, axis=1, kind="stable")[:, :2 * width]
        sims = np.take_along_axis(near, best, 1)
        links[:at] = diverse(unit_, np.where(np.isfinite(sims), best, -1), sims, width)
        while at < size:
            end = min(size, at + min(max(at // 2, 128), 1024))
            queries = unit_[at:end]
            high = [x for x in layers if len(x) <= at]
            starts = _descend(unit_, high, queries, 4)
            seeds = np.argsort(-(queries @ unit_[:min(at, 256)].T), axis=1)[:, :2]
            best, sims = walk(unit_[:at], links[:at], queries,
                              np.concatenate([starts, seeds], axis=1), beam)
            inside = queries @ queries.T
            inside[np.triu_indices(len(queries))] = -np.inf  # earlier ones of the batch only
            peers = np.argsort(-inside, axis=1, kind="stable")[:, :width]
            peer_sims = np.take_along_axis(inside, peers, 1)
            best = np.concatenate([best, np.where(np.isfinite(peer_sims), peers + at, -1)], axis=1)
            sims = np.concatenate([sims, peer_sims], axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            picked = diverse(unit_, np.take_along_axis(best, order, 1),
                             np.take_along_axis(sims, order, 1), degree)
            links[at:end, :degree] = picked
            _back(unit_, links, at, end, picked)
            at = end
        layers.insert(0, links)
    return Graph(ids, vectors, copies, [x.astype(np.int32) for x in layers])


def hits(graph: Graph, queries: np.ndarray, beam: int, cosine: float) -> list[np.ndarray]:
    """Positions of the vectors found within the threshold of each query, verified. A beam as wide
    as the graph, or a widened one that comes near it, reads all of it."""
    size, first = len(graph.ids), beam
    exact = unit(queries)
    single = exact.astype(np.float32)
    starts = _descend(graph.unit, graph.layers[1:], single, 8)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(queries)
    left, whole = np.arange(len(queries)), unit(graph.vectors)
    while len(left):
        wider = []
        for a in range(0, len(left), _QUERIES):
            some = left[a:a + _QUERIES]
            if beam >= size or beam > first and beam * _WHOLE >= size:
                for row, near in zip(some, exact[some] @ whole.T >= cosine, strict=True):
                    out[row] = np.flatnonzero(near).astype(np.int32)
                continue
            best, sims = walk(graph.unit, graph.layers[0], single[some], starts[some], beam)
            full = (best[:, -1] >= 0) & (sims[:, -1] >= cosine - SLACK)
            for row in np.flatnonzero(~full):
                at = best[row][(best[row] >= 0) & (sims[row] >= cosine - SLACK)]
                near = whole[at] @ exact[some[row]]
                out[some[row]] = at[near >= cosine].astype(np.int32)
            wider.append(some[full])
        left, beam = np.concatenate([*wider, left[:0]]), beam * 4
    return out


def audit(
    graph: Graph, ids: np.ndarray, queries: np.ndarray, cosine: float, audited: int
) -> list[tuple[int, np.ndarray]]:
    """(query, positions of its links) by brute force: queries in an order of chance until
    ``audited`` of them link with another vector, 16 times as many at most."""
    whole, exact = unit(graph.vectors), unit(queries)
    order = np.argsort(mix(np.arange(len(ids), dtype=np.uint64)), kind="stable")[:16 * audited]
    out = []
    for a in range(0, len(order), audited or 1):
        for i, near in zip(order[a:a + audited], exact[order[a:a + audited]] @ whole.T, strict=True):
            real = np.flatnonzero(near >= cosine)
            if (graph.ids[real] != ids[i]).any():
                out.append((int(i), real))
        if len(out) >= audited:
            break
    return out[:audited]


def audited_beam(
    graph: Graph, ids: np.ndarray, queries: np.ndarray, cosine: float, beam: int, recall: float,
    audited: int,
) -> int:
    """The beam widened until the audit is passed: ``recall`` is the mean over the audited
    queries, so a large group does not hide what small ones miss. A beam as wide as the graph
    passes by itself."""
    truth = audit(graph, ids, queries, cosine, audited)
    asked = queries[[i for i, _ in truth]]
    while truth and beam < len(graph.ids):
        found = hits(graph, asked, beam, cosine)
        if np.mean([len(np.intersect1d(real, got)) / len(real)
                    for (_, real), got in zip(truth, found, strict=True)]) >= recall:
            break
        beam *= 2
    return beam


def audited_hits(
    graph: Graph, ids: np.ndarray, queries: np.ndarray, cosine: float, beam: int, recall: float,
    audited: int,
) -> Iterator[np.ndarray]:
    """The hits of each query in turn; no more than a slice of them is held at once."""
    beam = audited_beam(graph, ids, queries, cosine, beam, recall, audited)
    for a in range(0, len(queries), _QUERIES):
        yield from hits(graph, queries[a:a + _QUERIES], beam, cosine)


class Pairs:
    """Which vectors of one graph link with which of another, a bit each."""

    def __init__(self, a: Graph, b: Graph):
        self.a, self.b = a, b
        self.bits = np.zeros((len(a.ids), -(-len(b.ids) // 8)), dtype=np.uint8)

    def add(self, row: np.ndarray | int, column: np.ndarray | int) -> None:
        """Marks pairs; either the rows or the columns are one number, the others differ."""
        if np.ndim(column):
            marked = np.zeros(len(self.b.ids), dtype=np.uint8)
            marked[column] = 1
            self.bits[row] |= np.packbits(marked)
        else:
            self.bits[row, column >> 3] |= np.uint8(128 >> (column & 7))

    def slices(self) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, truth values) of some rows at a time."""
        for at in range(0, len(self.bits), _ROWS):
            yield at, np.unpackbits(
                self.bits[at:at + _ROWS], axis=1, count=len(self.b.ids)
            ).view(bool)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each row and of each column, the vectors it links with, copies counted."""
        rows, columns = np.zeros(len(self.a.ids), np.int64), np.zeros(len(self.b.ids), np.int64)
        for at, found in self.slices():
            x, y = np.nonzero(found)
            np.add.at(rows, at + x, self.b.copies[y])
            np.add.at(columns, y, self.a.copies[at + x])
        return rows, columns

    def tied(self) -> tuple[np.ndarray, np.ndarray]:
        """Few links (node, node) that connect what all pairs connect."""
        left, right, more = [], [], 0
        for at, found in self.slices():
            x, y = np.nonzero(found)
            left.append(self.a.ids[at + x])
            right.append(self.b.ids[y])
            more += len(x)
            if more > _TIED:
                x, y = forest(np.concatenate(left), np.concatenate(right))
                left, right, more = [x], [y], 0
        return forest(np.concatenate(left), np.concatenate(right))


RESULT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else flat.chunk(0).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def near_vectors(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
    shard_rows: int = SHARD_ROWS, beam: int = BEAM, recall: float = RECALL, audited: int = AUDITED,
) -> DataFrame:
    """Links of cosine ``cosine`` or more, per vector.

    Columns: the key, n_links (other vectors linked directly), component_id (smallest key
    reachable over links, itself included), kept (key = component_id). Vectors that are null, empty,
    zero, or hold null or non-finite components link with nothing, nor do rows with a null key
    (component_id null, kept true); vectors of different lengths never link; equal vectors link and
    are indexed once; rows equal in key and vector are one vector, each row with its result; rows of
    one key with different vectors are different vectors, each with its own links, that link with
    one another only by cosine; an empty table gives no rows. Other columns are not read.

    Every shard meets every shard, so a graph is copied once per shard: the rows moved grow with the
    square of the table, divided by ``shard_rows``.
    """
    rows = embeddings.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector"))
    bad = "vector IS NULL OR key IS NULL OR exists(vector, x -> x IS NULL OR isnan(x) " \
        "OR abs(CAST(x AS DOUBLE)) = CAST('Infinity' AS DOUBLE)) OR NOT exists(vector, x -> x <> 0)"
    fit = rows.where(f"NOT ({bad})")
    # numbered before they are written, so a number stays with its vector
    classes = stored(
        fit.groupBy("key", "vector").agg(F.lit(1).alias("one"))
        .groupBy("vector").agg(F.min("key").alias("rep"), F.count("key").alias("copies"))
        .withColumns({"node": F.monotonically_increasing_id(), "seed": F.xxhash64("rep", "vector")}),
        "vector-classes",
    )
    shards = max(1, -(-classes.count() // shard_rows))
    dealt = classes.select(
        "node", "seed", "copies", "vector", F.size("vector").alias("dim"),
        F.pmod("seed", F.lit(shards)).cast("int").alias("shard"),
    )

    def construct(key_: tuple, table: pa.Table) -> pa.Table:
        dim = key_[0].as_py()
        graph = build(
            table["node"].to_numpy(), _matrix(table["vector"], dim), table["copies"].to_numpy(),
            table["seed"].to_numpy(),
        )
        return pa.table({"dim": [dim], "shard": [key_[1].as_py()], "graph": [graph.packed()]},
                        schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()),
                                          ("graph", pa.binary())]))

    graphs = stored(
        dealt.groupBy("dim", "shard").applyInArrow(construct, "dim int, shard int, graph binary"),
        "vector-graphs",
    )

    def search(key_: tuple, table: pa.Table) -> pa.Table:
        """The links between two shards, or within one."""
        one, other = key_[1].as_py(), key_[2].as_py()
        if table.num_rows < 1 + (one != other):
            return RESULT.empty_table()
        packed = dict(zip(table["shard"].to_pylist(), table["graph"].to_pylist(), strict=True))
        a, b = Graph.unpacked(packed[one]), Graph.unpacked(packed[other])
        found = Pairs(a, b)
        for row, at in enumerate(audited_hits(b, a.ids, a.vectors, cosine, beam, recall, audited)):
            if one == other:  # both ways, and no vector with itself
                at = at[at != row]
                found.add(at, row)
            found.add(row, at)
        if one != other:
            back = audited_hits(a, b.ids, b.vectors, cosine, beam, recall, audited)
            for column, at in enumerate(back):
                found.add(at, column)
        links, back_links = found.links()
        of = [(a, links)] if one == other else [(a, links), (b, back_links)]
        x, y = found.tied()
        counts = [(g.ids[n > 0], n[n > 0]) for g, n in of]
        nodes = np.concatenate([ids for ids, _ in counts])
        return pa.table({
            "a": np.concatenate([nodes, x]),
            "b": pa.array([*[None] * len(nodes), *y.tolist()], pa.int64()),
            "links": np.concatenate([*[n for _, n in counts], np.zeros(len(x), np.int64)]),
        }, schema=RESULT)

    pairs = graphs.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        "dim", "shard", "graph", F.least("shard", "with").alias("one"),
        F.greatest("shard", "with").alias("other"),
    )
    found = stored(
        pairs.groupBy("dim", "one", "other").applyInArrow(search, "a long, b long, links long"),
        "vector-links",
    )
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    hung = stored(
        components(found.where("b IS NOT NULL"), "a", "b")
        .join(classes.select("node", "rep"), "node"), "vector-components",
    )
    least = hung.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = (
        classes.join(links, classes["node"] == links["a"], "left")
        .join(hung.select("node", "component"), "node", "left").join(least, "component", "left")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component_id", "rep").alias("component_id"))
    )
    linked = fit.join(known, "vector").select("key", "n_links", "component_id")
    alone = rows.where(bad).select(
        "key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
