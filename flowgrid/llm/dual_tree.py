"""Ranked lexical search by dual trees, exact.

A document is a vector over the items' terms (what a term adds to a score, before its weight), an item the set of its
weighted terms, a score their inner product. Items form a binary tree; a node holds the terms of all items below it.
The documents of a task form one binary tree for each block of rows; a node holds, for every term, the largest
coordinate below it. For a pair of nodes, weights times coordinate maxima bound every score between the two batches: a
pair below the weakest k-th score of its items is pruned whole, others are split on both sides. Pairs of leaves are
scored with the highest bounds first. Each task hands on its k best documents of an item; these are merged by rank in
two steps, so that no item gathers a row of every task at once.

Items travel as broadcast blocks of about ``PAIRS`` (item, term) pairs, whatever the number of items; with more pairs
there are more blocks, each with a pass of its own. Statistics cover all documents.

Nulls and edges: a null or empty text, or one of separators alone, has no terms; it counts for nothing and is never
returned. Every row is a document: repeated rows rank one after the other. Rows that share an item_id (null included)
are one item with the terms of all of them. Equal scores: ascending doc_id, null last. Texts are read whole. Empty
tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgrid.llm.common import stored

PAIRS = 50_000
ROWS, CELLS, LEAF, ITEM_LEAF, STEP = 1024, 8_000_000, 16, 8, 8
#: Letters A-Z become small, other ASCII characters but digits and letters become spaces, all else stays.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def halved(x: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the rows of ``x`` (leaf * 2^i of them) in which every half, quarter, ... down to ``leaf`` rows lies
    together: a node's rows are cut by their inner products with its heaviest row."""
    order = np.arange(len(x))
    weight = x.sum(1)
    size = len(x)
    while size > leaf:
        for at in range(0, len(x), size):
            part = order[at:at + size]
            order[at:at + size] = part[np.argsort(-(x[part] @ x[part[weight[part].argmax()]]), kind="stable")]
        size //= 2
    return order


def padded(n: int, leaf: int) -> int:
    return leaf * 2 ** max(0, math.ceil(math.log2(max(1, n) / leaf)))


@dataclass
class Node:
    """Items ``lo`` to ``hi`` of the tree's order, their terms, and the nodes below."""
    lo: int
    hi: int
    terms: np.ndarray
    below: list[Node] = field(default_factory=list)


@dataclass
class Items:
    """A block of items: number of each term, weights, and the tree."""
    ids: list
    number: dict[bytes, int]
    terms: list[np.ndarray]
    weight: np.ndarray | None = None
    docs: int = 0
    length: int = 0
    root: Node | None = None
    table: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, pairs: list[tuple[int | None, bytes]]) -> Items:
        ids = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
        at = {i: n for n, i in enumerate(ids)}
        number = {t: n for n, t in enumerate(sorted({t for _, t in pairs}))}
        terms: list[list[int]] = [[] for _ in ids]
        for i, t in pairs:
            terms[at[i]].append(number[t])
        return cls(ids, number, [np.array(sorted(set(t)), np.int64) for t in terms])

    def weigh(self, df: np.ndarray, docs: int, length: int) -> Items:
        """Set the weights and build the tree. Terms that no document holds are left out of it."""
        self.docs, self.length = docs, length
        self.weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        order, todo = np.arange(len(self.ids)), [(0, len(self.ids))]
        while todo:  # the halves of a node share terms with its longest item, or do not
            lo, hi = todo.pop()
            if hi - lo <= ITEM_LEAF:
                continue
            long = self.terms[max(order[lo:hi], key=lambda i: len(self.terms[i]))]
            shared = [-int(self.weight[np.intersect1d(self.terms[i], long)].sum()) for i in order[lo:hi]]
            order[lo:hi] = order[lo:hi][np.argsort(shared, kind="stable")]
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
        self.ids, self.terms = [self.ids[i] for i in order], [self.terms[i][df[self.terms[i]] > 0] for i in order]
        self.root = self._node(0, len(self.ids))
        return self

    def _node(self, lo: int, hi: int) -> Node:
        node = Node(lo, hi, np.unique(np.concatenate(self.terms[lo:hi])))
        if hi - lo > ITEM_LEAF:
            node.below = [self._node(lo, (lo + hi) // 2), self._node((lo + hi) // 2, hi)]
        else:
            own = np.zeros((hi - lo, len(node.terms)))
            for i in range(lo, hi):
                own[i - lo, np.searchsorted(node.terms, self.terms[i])] = self.weight[self.terms[i]]
            self.table[lo] = own
        return node


class Search:
    """The k best documents of every item among the blocks of documents seen so far."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool))] * len(items.ids)
        self.theta = np.zeros(len(items.ids))
        self.scored = 0  # pairs of an item and a document whose score was computed
        # Sums of integers stay exact in doubles below 2^53; beyond, 64-bit integers.
        self.kind = np.float64 if len(items.number) * float(items.weight.max(initial=0)) * 1e6 < 2**53 else np.int64

    def block(self, ids: np.ndarray, missing: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """rows: per document the numbers of its terms, ascending, and their coordinates."""
        n = padded(len(rows), LEAF)
        x = np.zeros((n, len(self.items.number)), np.float32)  # coordinates are at most 10^6
        for r, (terms, value) in enumerate(rows):
            x[r, terms] = value
        order = halved(x, LEAF)
        self.ids, self.missing = np.resize(ids, n)[order], np.resize(missing, n)[order]
        self.x = np.ascontiguousarray(x[order].T)
        self.levels = [self.x.reshape(len(self.x), -1, LEAF).max(2)]
        while self.levels[-1].shape[1] > 1:
            self.levels.append(self.levels[-1].reshape(len(self.x), -1, 2).max(2))
        self._visit(self.items.root, len(self.levels) - 1, np.zeros(1, np.int64))

    def _visit(self, node: Node, level: int, docs: np.ndarray) -> None:
        if not len(node.terms):
            return
        most = self.items.weight[node.terms].astype(self.kind) @ self.levels[level][node.terms[:, None], docs].astype(self.kind)
        live = (most > 0) & (most >= self.theta[node.lo:node.hi].min())
        docs, most = docs[live], most[live]
        if not len(docs):
            return
        if level or node.below:
            if level:
                docs = np.concatenate([2 * docs, 2 * docs + 1])
            for below in node.below or [node]:
                self._visit(below, max(0, level - 1), docs)
            return
        order = np.argsort(-most, kind="stable")
        for at in range(0, len(order), STEP):
            part = order[at:at + STEP]
            part = part[most[part] >= self.theta[node.lo:node.hi].min()]
            if not len(part):
                return
            rows = (docs[part][:, None] * LEAF + np.arange(LEAF)).ravel()
            score = self.items.table[node.lo].astype(self.kind) @ self.x[node.terms[:, None], rows].astype(self.kind)
            self.scored += score.size
            for i in range(node.lo, node.hi):
                self._add(i, score[i - node.lo], rows)

    def _add(self, i: int, score: np.ndarray, rows: np.ndarray) -> None:
        take = (score > 0) & (score >= self.theta[i])
        if not take.any():
            return
        s, ids, missing = (np.concatenate(p) for p in zip(self.best[i], (score[take], self.ids[rows[take]], self.missing[rows[take]]), strict=True))
        top = np.lexsort((ids, missing, -s))[:self.k]
        self.best[i] = s[top], ids[top], missing[top]
        if len(top) == self.k:
            self.theta[i] = s[top[-1]]


def _term_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = sorted(set(words(text or b"")))
            ids += [i] * len(found)
            terms += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])


def _counter(shared):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.number
        df, docs, length = np.zeros(len(number), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0):
                found = words(text.as_py() or b"")
                docs, length = docs + bool(found), length + len(found)
                df[[number[t] for t in number.keys() & set(found)]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], at]), pa.int64()),
                                          pa.array(np.concatenate([[docs, length], df[at]]), pa.int64())], names=["term", "n"])
    return count


def _searcher(shared, k: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        items: Items = shared.value
        found = Search(items, k)
        most = max(LEAF, min(ROWS, CELLS // max(1, len(items.number)) // LEAF * LEAF))
        ids: list[int | None] = []
        rows: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if rows:
                found.block(np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]), rows)
            ids.clear()
            rows.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                terms = words(text.as_py() or b"")
                tf = Counter(terms)
                both = sorted((items.number[t], tf[t]) for t in items.number.keys() & tf.keys())
                if not both:
                    continue
                at, n = np.array(both, np.int64).T
                m = 10 + 90 * len(terms) * items.docs // items.length
                ids.append(i)
                rows.append((at, 1_000_000_000 * n // (1000 * n + 8 * m)))
                if len(rows) >= most:
                    flush()
        flush()
        out = [(items.ids[i], int(d) if not gone else None, int(s)) for i, best in enumerate(found.best) for s, d, gone in zip(*best, strict=True)]
        item, doc, score = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64()),
                                          pa.array([TaskContext.get().partitionId()] * len(out), pa.int32())],
                                         names=["item_id", "doc_id", "score", "part"])
    return search


def top_k(docs: DataFrame, benchmark: DataFrame, k: int = 10, pairs: int = PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents (doc_id, text) of highest positive score for each item of
    ``benchmark`` (item_id, text)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    owned = stored(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
                   .mapInArrow(_term_pairs, "item_id bigint, term binary").distinct(), "item-terms")
    blocks = max(1, -(-owned.count() // pairs))
    found = None
    for b in range(blocks):
        mine = owned.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else owned
        block = [(r.item_id, bytes(r.term)) for r in mine.toLocalIterator()]  # about ``pairs`` rows, or one item's terms
        if not block:
            continue
        items = Items.of(block)
        first = spark.sparkContext.broadcast(items)
        counts = {r.term: r.n for r in texts.select("text").mapInArrow(_counter(first), "term bigint, n bigint").groupBy("term")
                  .agg(F.sum("n").alias("n")).toLocalIterator()}  # a row for each term of the block
        df = np.array([counts.get(t, 0) for t in range(len(items.number))], np.int64)
        shared = spark.sparkContext.broadcast(items.weigh(df, counts.get(-2, 0), counts.get(-1, 0)))
        part = texts.mapInArrow(_searcher(shared, k), "item_id bigint, doc_id bigint, score bigint, part int")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")

    def ranked(df: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    some = ranked(found.withColumn("part", F.col("part") % 64), "item_id", "part").drop("rank")
    return ranked(some, "item_id").select("item_id", "rank", "doc_id", "score")
