"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages of STEP words. Only terms of the benchmark can add to an inner product with an item, so
the passage matrix keeps those columns: tf * idf, idf = max(0, log((RARE * N + 20) / df)) over the df of all N passages.
A randomised SVD of that matrix runs distributed: one pass sketches A'A times a random matrix, tasks send partial sums
by slabs of terms, and the right singular vectors follow from the small sketch. Latent vectors are linear in the words,
so a window is the sum of neighbouring passages; windows whose cosine with an item reaches ``cosine`` are candidates.
That idf is zero for the terms of an item that has leaked widely, and a window says little about an item far longer than
it. So every window is a candidate as well whose region holds the words that a match cannot do without: of an item's n
words a match leaves at most (1 - ``paraphrased``) n out, hence of its rarest terms, which make up CORE of the words, at
most as many; documents and then regions are held against that by counts. No match fails it, whatever idf or length.
Each candidate is checked on the words themselves: the longest common subsequence of item and window region over the
item's length is ``copied`` or more (a copy), or at least ``paraphrased`` while the item's answer (its last sentence,
else its last third) is kept to ``answered`` in order (a paraphrase).

Documents are encoded once, as positions of benchmark terms, into a stored table; the later passes read that. The
benchmark is a query set: it is handled in blocks of at most ITEMS items, whose terms and latent vectors are what is
shipped to tasks. No document, candidate or window is dropped.

Nulls and edges: null or empty texts match nothing; items without words are skipped; a document with several items gets
a row for each; repeated rows get theirs too; null ids stay null; either table empty gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.llm.common import stored, text_key, text_of, trimmed

STEP, RANK, OVER, ITEMS, SLAB, RARE, SLICE, PAIRS, HELD, CORE = 32, 160, 32, 5000, 64, 0.01, 250, 1 << 22, 1 << 19, 0.75
MATCH = "doc_id bigint, key struct<a:bigint,b:bigint>, item_id bigint, cosine double, lcs double, answer double, kind string"


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


@dataclass
class Items:
    """A block of benchmark items as term numbers; answer: where each item's answer begins."""

    ids: list
    terms: list[np.ndarray]
    answer: list[int]
    vocabulary: list[str]

    @classmethod
    def of(cls, rows: list) -> Items:
        number: dict[str, int] = {}
        ids, terms, answer = [], [], []
        for item_id, text in rows:
            w = words(text or "")
            if not w:
                continue
            sentences = [s for s in (words(s) for s in re.split(r"[.!?\n]+", text)) if s]
            tail = len(sentences[-1]) if len(sentences) > 1 else 0
            ids.append(item_id)
            answer.append(len(w) - (tail if 3 <= tail < len(w) else -(-len(w) // 3)))
            terms.append(np.array([number.setdefault(x, len(number)) for x in w], np.int32))
        return cls(ids, terms, answer, list(number))


def _encode(vocabulary: list[str]):
    """doc_id, key, and for every benchmark term in a text its number and the gap to the one before."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                raw = pc.utf8_split_whitespace(pc.utf8_lower(batch.column(2)))
                coded = raw.values.slice(raw.offsets[0].as_py(), raw.offsets[-1].as_py() - raw.offsets[0].as_py()).dictionary_encode()
                # words of each distinct string between blanks, then those of every occurrence in turn
                parts = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(
                    pc.replace_substring_regex(coded.dictionary, r"[^\pL\pN]+", " ")))
                word = pc.not_equal(parts.values, "").to_numpy(zero_copy_only=False)  # no word at all splits into one empty
                ids = pc.fill_null(pc.index_in(parts.values, value_set=known), -1).to_numpy().astype(np.int32)[word]
                bounds = np.concatenate([[0], np.cumsum(word)])[parts.offsets.to_numpy()].astype(np.int32)
                each = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids)).take(coded.indices)
                number = each.flatten().to_numpy(zero_copy_only=False)
                offsets = each.offsets.to_numpy()[raw.offsets.to_numpy() - raw.offsets[0].as_py()]
                hit = np.flatnonzero(number >= 0)
                cut = np.searchsorted(hit, offsets).astype(np.int32)
                doc = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
                pos = hit - offsets[doc]
                gap = np.diff(pos, prepend=0)
                first = cut[:-1][np.diff(cut) > 0]
                gap[first] = pos[first]
                lists = lambda v: pa.ListArray.from_arrays(pa.array(cut), pa.array(v.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(number[hit]), lists(gap)],
                                                 names=["doc_id", "key", "term", "gap"])
    return run


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, position, document) of every benchmark term of a batch of encoded documents."""
    term = batch.column(2).flatten().to_numpy(zero_copy_only=False)
    offsets = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    total = np.cumsum(batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    before = np.concatenate([[0], total])[offsets[:-1]]
    return term, (total - before[doc]).astype(np.int64), doc


def _passages(pos: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first term of each passage that has one, its document, its number in the document)."""
    number = pos // STEP
    if not len(pos):
        return np.array([], np.int64), doc, number
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(number) != 0)]))
    return starts, doc[starts], number[starts]


def _frequencies(terms: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms + 1, np.int64)
        for batch in batches:
            term, pos, doc = _read(batch)
            starts, _, _ = _passages(pos, doc)
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(term))))
            pair = np.sort(passage * terms + term)
            df[:terms] += np.bincount(pair[np.diff(pair, prepend=-1) > 0] % terms, minlength=terms)
            df[terms] += len(starts)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df)), pa.array(df[df > 0])], names=["term", "df"])
    return run


def _latent(term: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the terms' rows in each passage."""
    live = np.flatnonzero(rows.any(1)[term])
    passage = np.searchsorted(starts, live, side="right") - 1
    out = np.zeros((len(starts), rows.shape[1]), rows.dtype)
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    rank = np.arange(len(live)) - np.repeat(first, np.diff(np.append(first, len(live))))
    order = np.argsort(rank, kind="stable")
    at = 0
    for n in np.bincount(rank):  # the first term of every passage, then the second, ..
        part = order[at:at + n]
        out[passage[part]] += rows[term[live[part]]]
        at += n
    return out


def _pairs(term: np.ndarray, starts: np.ndarray, live: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(first * terms + second, count) of the ordered pairs of live terms that share a passage, a term with itself
    included."""
    passage = np.searchsorted(starts, live, side="right") - 1
    t = term[live].astype(np.int64)
    keys = [t * terms + t]
    for step in range(1, STEP):
        same = np.flatnonzero(passage[step:] == passage[:-step])
        if not len(same):
            break
        keys += [t[same] * terms + t[same + step], t[same + step] * terms + t[same]]
    return _counted(np.concatenate(keys), None)


def _counted(keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _sketch(idf: np.ndarray, seed: int, width: int):
    """Partial sums of A'(A W) by slabs of terms, W random: the pairs of terms in the task's passages are counted first,
    as A'A holds no more, and then meet W slab by slab."""
    terms = len(idf)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, least = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                term, pos, doc = _read(batch.slice(at, SLICE))
                starts, _, _ = _passages(pos, doc)
                if len(starts):
                    parts.append(_pairs(term, starts, np.flatnonzero(idf[term] > 0), terms))
                    held += len(parts[-1][0])
                if held > HELD + 2 * least:  # as much again as is known, so that counting anew stays rare
                    parts = [_counted(*(np.concatenate(c) for c in zip(*parts, strict=True)))]
                    held = least = len(parts[0][0])
        if not parts:
            return
        keys, counts = _counted(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        random = np.random.default_rng(seed).standard_normal((terms, width)).astype(np.float32) * idf[:, None]
        for slab in range(0, terms, SLAB):
            lo, hi = np.searchsorted(keys, [slab * terms, (slab + SLAB) * terms])
            if lo < hi:
                block = np.zeros((min(SLAB, terms - slab), terms), np.float32)
                block.ravel()[keys[lo:hi] - slab * terms] = counts[lo:hi]
                total = (block @ random).astype(np.float64) * idf[slab:slab + SLAB, None]
                yield pa.RecordBatch.from_arrays([pa.array([slab // SLAB], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                                 names=["slab", "part"])
    return run


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            v = np.frombuffer(part)
            sums[slab] = sums[slab] + v if slab in sums else v
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(
        [v.tobytes() for v in sums.values()], pa.binary())], names=["slab", "part"])


def right_vectors(sketch: np.ndarray, random: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors of A from A'A W and W (single-pass Nystroem form)."""
    small = random.T @ sketch
    value, vector = np.linalg.eigh((small + small.T) / 2)
    keep = value > max(value.max(initial=0) * 1e-9, 1e-12)
    if not keep.any():
        return np.zeros((len(sketch), 0))
    u, s, _ = np.linalg.svd(sketch @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    return u[:, s > s[0] * 1e-6][:, :rank]


def lcs(masks: dict[int, int], length: int, other: Iterable[int]) -> int:
    """Longest common subsequence, bit-parallel; masks: positions of each term in the item."""
    full = (1 << length) - 1
    v = full
    for t in other:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


def _masks(terms: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        out[t] = out.get(t, 0) | 1 << i
    return out


class Core:
    """The rarest terms of each item, CORE of its words at least, and how many of those words a match needs."""

    def __init__(self, items: Items, df: np.ndarray, paraphrased: float):
        self.items, self.need, terms, owners, words = len(items.ids), [], [], [], []
        self.member = np.zeros((len(items.ids), len(items.vocabulary)), bool)
        for i, t in enumerate(items.terms):
            own, times = np.unique(t, return_counts=True)
            order = np.argsort(df[own], kind="stable")
            held = np.cumsum(times[order])
            core = order[:np.searchsorted(held, CORE * len(t)) + 1]
            self.member[i, own[core]] = True
            self.need.append(times[core].sum() - (len(t) - math.ceil(paraphrased * len(t) - 1e-9)))
            terms.append(own[core])
            owners.append(np.full(len(core), i))
            words.append(times[core])
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.owner, self.words, self.need = np.concatenate(owners)[order], np.concatenate(words)[order], np.array(self.need)
        self.first = np.searchsorted(term[order], np.arange(len(items.vocabulary) + 1))

    def documents(self, term: np.ndarray, doc: np.ndarray, docs: int) -> list[tuple[int, int]]:
        """(document, item) wherever the document holds as many core words as a match needs."""
        terms, held = len(self.first) - 1, np.zeros(docs * self.items)
        pair = np.unique(doc * terms + term)
        d, t = pair // terms, pair % terms
        each = self.first[t + 1] - self.first[t]
        end = np.cumsum(each)
        at = 0
        while at < len(pair):
            to = max(at + 1, int(np.searchsorted(end, end[at] + PAIRS // 4)))
            n = each[at:to]
            entry = np.arange(n.sum()) + np.repeat(self.first[t[at:to]] - (np.cumsum(n) - n), n)
            lo, hi = d[at] * self.items, (d[to - 1] + 1) * self.items
            held[lo:hi] += np.bincount(np.repeat(d[at:to], n) * self.items + self.owner[entry] - lo, self.words[entry], hi - lo)
            at = to
        found = np.flatnonzero((held.reshape(docs, self.items) >= self.need).ravel())
        return [divmod(int(f), self.items) for f in found]


def _search(shipped, cosine: float, copied: float, paraphrased: float, answered: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vectors, queries, core = shipped.value
        member = np.zeros((len(items.ids), len(items.vocabulary)), bool)
        for i, t in enumerate(items.terms):
            member[i, t] = True
        item_masks = [_masks(t) for t in items.terms]
        answer_masks = [_masks(t[a:]) for t, a in zip(items.terms, items.answer, strict=True)]
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                term, pos, doc = _read(batch)
                starts, p_doc, p_number = _passages(pos, doc)
                if not len(starts):
                    continue
                z = _latent(term, starts, vectors)
                near = np.concatenate([(np.diff(p_doc) == 0) & (np.diff(p_number) == 1), [False]])
                window = z.copy()
                window[near] += z[1:][near[:-1]]
                norm = np.sqrt((window * window).sum(1))
                live = np.flatnonzero(norm > 0)
                found: dict[tuple[int, int], tuple] = {}

                def judge(d: int, i: int, region: list[int], c: float, found: dict = found) -> None:
                    n = len(items.terms[i])
                    share = lcs(item_masks[i], n, region) / n if len(region) >= paraphrased * n else 0.0
                    if share < paraphrased:
                        return
                    kept = lcs(answer_masks[i], n - items.answer[i], region) / (n - items.answer[i])
                    if share >= copied or kept >= answered:
                        found[d, i] = max((share, kept, c), found.get((d, i), ()))

                edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                for lo in range(0, len(live), 8192):
                    part = live[lo:lo + 8192]
                    cos = (window[part] / norm[part, None]) @ queries.T
                    for r, i in zip(*np.nonzero(cos >= cosine), strict=True):
                        p, c = part[r], float(cos[r, i])
                        d, n = int(p_doc[p]), len(items.terms[i])
                        a, b = edge[d], edge[d + 1]
                        mid = STEP * p_number[p]
                        a, b = a + np.searchsorted(pos[a:b], mid - n), a + np.searchsorted(pos[a:b], mid + 2 * STEP + n)
                        region = term[a:b]
                        region = region[member[i, region]].tolist()
                        judge(d, i, region, c)
                for d, i in core.documents(term, doc, batch.num_rows):
                    n, own = len(items.terms[i]), edge[d] + np.flatnonzero(member[i, term[edge[d]:edge[d + 1]]])
                    rare = np.concatenate([[0], np.cumsum(core.member[i, term[own]])])
                    first, last = np.searchsorted(p_doc, [d, d + 1])
                    mid = STEP * p_number[first:last]
                    a, b = np.searchsorted(pos[own], mid - n), np.searchsorted(pos[own], mid + 2 * STEP + n)
                    full = np.flatnonzero((b - a >= paraphrased * n) & (rare[b] - rare[a] >= core.need[i]))
                    for r in full[np.argsort(a[full] - b[full], kind="stable")]:  # the fullest region first
                        share = found.get((d, i), (0.0,))[0]
                        if share == 1 or share > (b[r] - a[r]) / n:
                            break  # no region that follows can hold more
                        p = first + r
                        judge(d, i, term[own[a[r]:b[r]]].tolist(), float(window[p] @ queries[i] / norm[p]) if norm[p] > 0 else 0.0)
                if found:
                    docs = pa.array([d for d, _ in found])
                    best = list(found.values())
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(docs), batch.column(1).take(docs),
                        pa.array([items.ids[i] for _, i in found], pa.int64()), pa.array([x[2] for x in best], pa.float64()),
                        pa.array([x[0] for x in best], pa.float64()), pa.array([x[1] for x in best], pa.float64()),
                        pa.array(["copy" if x[0] >= copied else "paraphrase" for x in best])],
                        names=["doc_id", "key", "item_id", "cosine", "lcs", "answer", "kind"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.4, copied: float = 0.8, paraphrased: float = 0.6,
            answered: float = 0.8, seed: int = 5) -> DataFrame:
    """doc_id, key (text identity), item_id, cosine, lcs, answer, kind of every document and item that match."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text"))
    blocks = -(-items.count() // ITEMS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * blocks - 1 if blocks > 1 else 1))  # twice as many leave room
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(text_of()).alias("key"), text_of().alias("text"))
    out = spark.range(0).select(F.from_json(F.lit("{}"), MATCH).alias("m")).select("m.*")  # no Python workers of its own
    for block in range(2 * blocks - 1 if blocks > 1 else blocks):
        some = Items.of(sorted((tuple(r) for r in items.where(part == block).collect()), key=repr))
        if not some.ids:
            continue
        terms = len(some.vocabulary)
        coded = stored(rows.mapInArrow(trimmed(_encode(some.vocabulary)), "doc_id bigint, key struct<a:bigint,b:bigint>, "
                                       "term array<int>, gap array<int>"), "encoded")
        df = np.zeros(terms + 1)
        for t, n in coded.mapInArrow(_frequencies(terms), "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
            df[t] = n
        idf = np.maximum(0, np.log((RARE * df[terms] + 20) / np.maximum(df[:terms], 1))).astype(np.float32)
        width = min(RANK + OVER, terms)
        slabs = (coded.mapInArrow(trimmed(_sketch(idf, seed, width)), "slab int, part binary").repartition("slab")
                 .mapInArrow(_add_up, "slab int, part binary").collect())  # terms of a block x width
        sketch = np.zeros((terms, width))
        for slab, part_sum in slabs:
            sketch[slab * SLAB:(slab + 1) * SLAB] = np.frombuffer(part_sum).reshape(-1, width)
        random = np.random.default_rng(seed).standard_normal((terms, width)).astype(np.float32)
        vectors = (right_vectors(sketch, random.astype(float), RANK) * idf[:, None]).astype(np.float32)
        queries = np.stack([vectors[t].sum(0) for t in some.terms])
        length = np.sqrt((queries * queries).sum(1, keepdims=True))
        queries = np.divide(queries, length, out=np.zeros_like(queries), where=length > 0)
        shipped = spark.sparkContext.broadcast((some, vectors, queries, Core(some, df[:terms], paraphrased)))
        out = out.union(coded.mapInArrow(trimmed(_search(shipped, cosine, copied, paraphrased, answered)), MATCH))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay. Texts are matched by identity."""
    bad = stored(matches(docs, benchmark).select(F.col("key.a").alias("__a"), F.col("key.b").alias("__b")).distinct(), "leaks")
    key = text_key(text_of())
    return (docs.withColumns({"__a": key["a"], "__b": key["b"]}).join(bad, ["__a", "__b"], "left_anti").select(*docs.columns))
