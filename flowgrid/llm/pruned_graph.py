"""Approximate nearest neighbours by cosine: robust-pruned directed graphs, one for each shard of rows.

Rows are dealt to shards by a hash of id and vector, so a group of equal vectors, however large, spreads over all of
them. Equal vectors of a shard are one point of its graph. Points are inserted in batches: a greedy search from
points far apart proposes neighbours, pruning keeps an edge only if no kept edge leads ``alpha`` times closer to its end, and
edges back are pruned alike. A second pass over all points repeats this on the finished graph. The graphs are written to
the shared folder. Queries travel in broadcast groups of bounded size; a beam search asks every shard, the points of
the beam are scored anew in double precision on the original vectors, and the best of all shards are merged by rank.

Every row is in a graph; nothing is sampled. Search is approximate: recall depends on ``beam`` and ``degree``.

Nulls and edges: null ids, null or zero vectors and vectors with null or non-finite components take no part. Shorter
vectors count as padded by zeros. A query never meets its own id; rows sharing an id count once, with the best score.
Equal scores go to the smaller id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgrid.llm.common import gathered, stored

SHARD, GROUP_BYTES, BATCH, STARTS = 8192, 16_000_000, 256, 64
PACKED = "shard int, dims int, ids binary, data binary"
GRAPH = "shard int, dims int, starts array<int>, ids binary, data binary, point binary, edges binary"


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of doubles, padded with zeros to the longest."""
    length = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1]) < length[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that its squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def ordered(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, equal vectors together and by id."""
    order = np.lexsort((ids, *x.T))
    ids, x = ids[order], x[order]
    keep = np.concatenate([[True], (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(1)])[:len(ids)]
    return ids[keep], x[keep]


def spread(x: np.ndarray, many: int) -> np.ndarray:
    """Up to ``many`` points far from each other, the one nearest the mean first. A search starts from all of them: a
    dense group of points may have no edge that leaves it, so no single start would do."""
    out = [int(np.argmax(x @ x.mean(0)))]
    far = 2 - 2 * (x @ x[out[0]])
    while len(out) < min(many, len(x)):
        out.append(int(np.argmax(far)))
        far = np.minimum(far, 2 - 2 * (x @ x[out[-1]]))
    return np.unique(out)


class Graph:
    """Directed graph over points on the unit sphere; ``edges`` is padded with -1."""

    def __init__(self, x: np.ndarray, degree: int, alpha: float, edges: np.ndarray | None = None, starts: np.ndarray | None = None):
        self.x, self.degree, self.alpha2 = x, degree, np.float32(alpha * alpha)
        self.edges = np.full((len(x), degree), -1, np.int32) if edges is None else edges
        self.starts = spread(x, STARTS) if starts is None else starts

    def beam(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy searches of all rows of ``q`` in step: per row the ``width`` nearest points met, nearest first, -1
        where there are fewer, and their squared distances. Each step opens the nearest unopened point of every beam."""
        n = len(q)
        at = np.full((n, max(width, len(self.starts))), -1, np.int64)
        dist = np.full(at.shape, np.inf, np.float32)
        first = 2 - 2 * (q @ self.x[self.starts].T)
        order = np.argsort(first, 1, kind="stable")
        at[:, :order.shape[1]], dist[:, :order.shape[1]] = self.starts[order], np.take_along_axis(first, order, 1)
        at, dist = at[:, :width], dist[:, :width]
        opened = np.zeros(at.shape, bool)
        seen = np.zeros((n, len(self.x)), bool)
        seen[:, self.starts] = True
        rows = np.arange(n)
        while len(rows):
            todo = ~opened[rows] & (at[rows] >= 0)
            rows = rows[todo.any(1)]
            if not len(rows):
                break
            pick = np.argmax(~opened[rows] & (at[rows] >= 0), 1)  # beams are sorted: the first is the nearest
            opened[rows, pick] = True
            near = self.edges[at[rows, pick]].astype(np.int64)
            fresh = (near >= 0) & ~seen[rows[:, None], near]
            seen[rows[:, None], np.where(near >= 0, near, self.starts[0])] = True
            d = np.where(fresh, 2 - 2 * np.einsum("rd,rkd->rk", q[rows], self.x[near]), np.inf).astype(np.float32)
            all_d = np.concatenate([dist[rows], d], 1)
            order = np.argsort(all_d, 1, kind="stable")[:, :width]
            dist[rows] = np.take_along_axis(all_d, order, 1)
            at[rows] = np.where(np.isinf(dist[rows]), -1, np.take_along_axis(np.concatenate([at[rows], near], 1), order, 1))
            opened[rows] = np.take_along_axis(np.concatenate([opened[rows], np.zeros(near.shape, bool)], 1), order, 1)
        return at, dist

    def prune(self, p: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Per point the edges that remain of its candidates (-1: none): nearest first, each one drops the candidates
        that lie ``alpha`` times closer to it than to the point."""
        near = np.sort(near, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[near == p[:, None]] = -1
        vectors = self.x[near]
        d = np.where(near >= 0, 2 - 2 * np.einsum("rd,rkd->rk", self.x[p], vectors), np.inf)
        order = np.argsort(d, 1, kind="stable")
        near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
        vectors = np.take_along_axis(vectors, order[..., None], 1)
        alive = np.isfinite(d)
        out = np.full((len(p), self.degree), -1, np.int32)
        rows = np.arange(len(p))
        for k in range(self.degree):
            if not alive.any():
                break
            pick = np.argmax(alive, 1)
            has = alive[rows, pick]
            out[has, k] = near[has, pick[has]]
            between = 2 - 2 * np.einsum("rd,rkd->rk", vectors[rows, pick], vectors)
            alive &= ~(has[:, None] & (self.alpha2 * between <= d))
            alive[rows, pick] = False
        return out

    def insert(self, p: np.ndarray, width: int) -> None:
        found, _ = self.beam(self.x[p], width)
        self.edges[p] = self.prune(p, np.concatenate([found, self.edges[p]], 1))
        to, back = self.edges[p].ravel(), np.repeat(p, self.degree)
        back, to = back[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        ends, first, count = np.unique(to, return_index=True, return_counts=True)
        for some in np.array_split(np.arange(len(ends)), max(1, len(ends) // 1024)):
            if not len(some):
                continue
            new = np.full((len(some), int(count[some].max())), -1, np.int64)
            rank = np.arange(len(to)) - np.repeat(first, count)
            mine = np.isin(to, ends[some])
            new[np.searchsorted(ends[some], to[mine]), rank[mine]] = back[mine]
            old = self.edges[ends[some]]
            new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
            full = (old >= 0).sum(1) + (new >= 0).sum(1) > self.degree
            both = np.concatenate([old, new], 1)
            if full.any():
                self.edges[ends[some][full]] = self.prune(ends[some][full], both[full])
            keep = both[~full]
            self.edges[ends[some][~full]] = np.take_along_axis(keep, np.argsort(keep < 0, 1, kind="stable"), 1)[:, :self.degree]

    @classmethod
    def built(cls, x: np.ndarray, degree: int, alpha: float, width: int) -> Graph:
        g = cls(x, degree, 1.0)
        order = np.random.default_rng(7).permutation(len(x))
        for alpha_ in (1.0, alpha):  # first a plain pass, then the relaxed one, as edges of all points are known
            g.alpha2 = np.float32(alpha_ * alpha_)
            at, size = 0, 1
            while at < len(order):
                g.insert(order[at:at + size], width)
                at += size
                size = min(BATCH, max(size * 2, 1)) if alpha_ == 1.0 else BATCH
        return g


def _packed(shards: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 8192):
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            home = batch.column(2).to_numpy() % shards
            for s in np.unique(home):
                some, rows = ordered(ids[home == s], x[home == s])  # repeated rows meet here already
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(s)], pa.int32()), pa.array([x.shape[1]], pa.int32()), pa.array([some.tobytes()], pa.binary()),
                    pa.array([rows.tobytes()], pa.binary())], names=["shard", "dims", "ids", "data"])
    return pack


def _builder(degree: int, alpha: float, width: int, k: int):
    def graph(shard: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        dims = max(x.shape[1] for _, x in parts)
        x = np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for _, p in parts]) + 0.0
        ids, x = ordered(np.concatenate([i for i, _ in parts]), x)
        again = np.concatenate([[False], (x[1:] == x[:-1]).all(1)])  # of equal rows only the k + 1 first ids can be among k
        start = np.maximum.accumulate(np.where(again, 0, np.arange(len(ids))))
        keep = np.arange(len(ids)) - start <= k
        ids, x = ids[keep], x[keep]
        unit = units(x)
        _, first, point = np.unique(np.round(unit, 6), axis=0, return_index=True, return_inverse=True)
        g = Graph.built(unit[first], degree, alpha, width)
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int32()), pa.array([dims], pa.int32()), pa.array([g.starts.tolist()], pa.list_(pa.int32())), pa.array([ids.tobytes()], pa.binary()),
            pa.array([x.tobytes()], pa.binary()), pa.array([point.ravel().astype(np.int32).tobytes()], pa.binary()),
            pa.array([g.edges.tobytes()], pa.binary())], names=["shard", "dims", "starts", "ids", "data", "point", "edges"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            for shard, dims, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != held and parts:
                    yield graph(held, parts)
                    parts = []
                held = shard
                parts.append((np.frombuffer(ids, np.int64), np.frombuffer(data).reshape(-1, dims)))
        if parts:
            yield graph(held, parts)
    return build


def nearest(g: Graph, ids: np.ndarray, x: np.ndarray, point: np.ndarray, own: np.ndarray, q: np.ndarray, width: int, k: int):
    """(query_id, vec_id, score) of the best k rows of a shard for each query; x, q: original vectors of one width."""
    found, _ = g.beam(units(q), width)
    order = np.argsort(point, kind="stable")
    first = np.searchsorted(point[order], np.arange(len(g.x) + 1))
    x, q = scaled(x), scaled(q)
    size, q_size = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
    for r, at in enumerate(found):
        at = at[at >= 0]
        rows = np.concatenate([order[first[a]:first[a + 1]] for a in at])
        rows = rows[ids[rows] != own[r]]
        score = np.einsum("nd,d->n", x[rows], q[r]) / (size[rows] * q_size[r])
        top = np.lexsort((ids[rows], -score))
        _, once = np.unique(ids[rows][top], return_index=True)  # an id counts once, with its best row
        top = top[np.sort(once)][:k]
        yield np.full(len(top), own[r]), ids[rows[top]], score[top]


def _searcher(shared, width: int, k: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = shared.value
        for batch in batches:
            for _, dims, starts, ids, data, point, edges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, wide = np.frombuffer(data).reshape(-1, dims), max(dims, queries.shape[1])
                x = np.pad(x, ((0, 0), (0, wide - dims)))
                point = np.frombuffer(point, np.int32)
                _, one = np.unique(point, return_index=True)
                edges = np.frombuffer(edges, np.int32).reshape(len(one), -1)
                g = Graph(units(x[one]), edges.shape[1], 1.0, edges, np.array(starts))
                for lo in range(0, len(own), BATCH):
                    q = np.pad(queries[lo:lo + BATCH], ((0, 0), (0, wide - queries.shape[1])))
                    out = list(nearest(g, np.frombuffer(ids, np.int64), x, point, own[lo:lo + BATCH], q, width, k))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                     names=["query_id", "vec_id", "score"])
    return search


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return rows.where(fine & F.exists("embedding", lambda x: x != 0))


def index(rows: DataFrame, shard_rows: int = SHARD, degree: int = 32, alpha: float = 1.2, width: int = 64, k: int = 5) -> DataFrame:
    """One stored row for each shard: its vectors and its graph. ``k``: neighbours that a search may ask for."""
    shards = max(1, -(-rows.count() // shard_rows))
    packed = rows.withColumn("at", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")).mapInArrow(_packed(shards), PACKED)
    return stored(packed.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_builder(degree, alpha, width, k), GRAPH), "graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int = 5, width: int = 96) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row of ``queries`` (vec_id, embedding)."""
    spark = graphs.sparkSession
    asked = queries.agg(F.count("*"), F.max(F.size("embedding"))).first()
    groups = max(1, -(-asked[0] * (asked[1] or 0) * 8 // GROUP_BYTES))
    found = None
    for g in range(groups):
        some = queries.where(F.pmod(F.xxhash64("vec_id", "embedding", F.lit(1)), F.lit(groups)) == g) if groups > 1 else queries
        block = some.select("vec_id", "embedding").toArrow().combine_chunks()  # about GROUP_BYTES
        if not block.num_rows:
            continue
        ids, lists = block.column(0).combine_chunks(), block.column(1).combine_chunks()
        shared = spark.sparkContext.broadcast((ids.to_numpy(), matrix(lists)))
        part = graphs.mapInArrow(_searcher(shared, width, k), "query_id bigint, vec_id bigint, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` nearest other rows of each row of ``vectors`` (vec_id, embedding) whose id is divisible by ``every``."""
    rows = usable(vectors)
    return search(index(rows, k=k), rows.where(F.col("vec_id") % every == 0), k)
