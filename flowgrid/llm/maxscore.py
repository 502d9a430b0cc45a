"""Exact top-k inner products by MaxScore: every dimension is a query term, its column of a shard the posting list.

Vectors are packed into shards of about SHARD rows; queries travel to every shard in packed blocks. In a shard each
dimension has a bound on what it can add to a query's score. Dimensions are ordered by the range of their bounds; the
last ones whose ranges together stay below the threshold (the k-th best score so far) are non-essential. Essential
postings are added up for all rows, the others only for rows that can still reach the threshold. The best k of all
shards are merged by rank.

Scores are integers. Sums below 2^24 or 2^53 are exact in float32 or float64, which only changes speed; larger ones use
64-bit integers.

Nulls and edges: vectors that are null or hold null or non-finite components take no part, nor do null ids. Shorter
vectors count as padded by zeros. Rows sharing an id count once, with their best score; a query never meets its own
id. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgrid.llm.common import gathered

SHARD, PACK = 8192, 8192
PACKED = "shard int, role int, dims int, ids binary, data binary"


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """ids and an int64 matrix, rows padded with zeros to the longest."""
    lists = batch.column(1)
    length = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(length), int(length.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < length[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), out


def _packer(shards: int, every: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, PACK):
            ids, x = _matrix(batch)
            home = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(shards)
            asks = ids % every == 0
            rows = [(s, 0, home == s) for s in np.unique(home)]
            rows += [(s, 1, asks) for s in range(shards) if asks.any()]
            yield pa.RecordBatch.from_arrays([
                pa.array([int(s) for s, _, _ in rows], pa.int32()), pa.array([r for _, r, _ in rows], pa.int32()),
                pa.array([x.shape[1]] * len(rows), pa.int32()), pa.array([ids[m].tobytes() for _, _, m in rows], pa.binary()),
                pa.array([x[m].tobytes() for _, _, m in rows], pa.binary())], names=["shard", "role", "dims", "ids", "data"])
    return pack


def top_of_shard(ids: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, q: np.ndarray, own: int,
                 k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of one query's best k rows of a shard. postings: one row per dimension; low, high: their bounds."""
    most, least = np.maximum(q * low, q * high), np.minimum(q * low, q * high)
    order = np.argsort(least - most, kind="stable")  # widest range first
    spread = (most - least)[order]
    first = q @ postings[:, :4 * k]  # a first threshold from complete scores of a few rows
    first = first[ids[:4 * k] != own]
    theta = np.partition(first, len(first) - k)[len(first) - k] if len(first) >= k else -np.inf
    rest = np.concatenate([np.cumsum(spread[::-1])[::-1], [0]])  # range of the dimensions from here on
    shifted = theta - least.sum()
    cut = int(np.argmax(rest < shifted)) if shifted > 0 and (rest < shifted).any() else len(order)
    cut = max(cut, min(len(order), 1))
    above = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0]])
    score = q[order[:cut]] @ postings[order[:cut]]
    live = np.flatnonzero(score + above[cut] >= theta)
    score = score[live]
    step = 8
    for at in range(cut, len(order), step):
        dims = order[at:at + step]
        score = score + q[dims] @ postings[np.ix_(dims, live)]
        keep = score + above[min(at + step, len(order))] >= theta
        live, score = live[keep], score[keep]
    other = ids[live] != own
    live, score = live[other], score[other]
    if len(live) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        live, score = live[score >= bar], score[score >= bar]
    best = np.lexsort((ids[live], -score))[:k]
    return ids[live[best]], score[best]


class Layer:
    """Rows of a shard with different ids, as posting lists in the number types that the scores need."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.postings = ids, np.ascontiguousarray(x.T)
        self.low, self.high = self.postings.min(1, initial=0), self.postings.max(1, initial=0)
        self.cast: dict[type, np.ndarray] = {}

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        q = np.pad(q, (0, max(0, len(self.postings) - len(q))))[:len(self.postings)]
        most = float(np.abs(q).astype(float) @ np.maximum(np.abs(self.low), np.abs(self.high)).astype(float))
        kind = np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64
        if kind not in self.cast:
            self.cast[kind] = self.postings.astype(kind)
        best, score = top_of_shard(self.ids, self.cast[kind], self.low.astype(kind), self.high.astype(kind), q.astype(kind), own, k)
        return best, score.astype(np.int64)


def _layers(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[Layer]:
    """A shard's rows so that no layer holds an id twice; repeated rows count once. An id's best row is among the best
    of its layer, so merging the layers' best by id loses nothing."""
    width = max(p.shape[1] for _, p in parts)
    ids = np.concatenate([i for i, _ in parts])
    x = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for _, p in parts])
    if len(np.unique(ids)) == len(ids):
        return [Layer(ids, x)]
    rows = np.unique(np.column_stack([ids, x]), axis=0)
    ids, x = rows[:, 0].copy(), rows[:, 1:]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return [Layer(ids[rank == r], x[rank == r]) for r in range(int(rank.max()) + 1)]


def _searcher(k: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, ready = None, [], None
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s, role, dims, raw_ids, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    shard, parts, ready = s, [], None
                ids, x = np.frombuffer(raw_ids, np.int64), np.frombuffer(raw, np.int64).reshape(-1, dims)
                if role == 0:
                    parts.append((ids, x))
                    continue
                if not parts:
                    continue
                if ready is None:
                    ready = _layers(parts)
                for layer in ready:
                    for own, q in zip(ids, x, strict=True):
                        best, score = layer.top(q, own, k)
                        out.append((np.full(len(best), own), best, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 names=["query_id", "vec_id", "score"])
    return search


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` the k best other rows.

    ``vectors`` (vec_id, embedding); component x counts as floor(scale * x).
    """
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = (vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("x")))
    shards = max(1, -(-vectors.count() // shard_rows))
    packed = rows.mapInArrow(_packer(shards, every), PACKED)
    found = (packed.repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "role")
             .mapInArrow(_searcher(k), "query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
