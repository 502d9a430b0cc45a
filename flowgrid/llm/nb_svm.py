"""Quality classifier: naive Bayes support vectors.

A text is the set of its byte 3-grams (hashed to 2^16) plus n-grams of the token <same>, which stands for a word equal to
the one before it. Each indicator is scaled by the log ratio of its smoothed counts in the two classes, and a linear
hinge-loss model is fitted by dual coordinate descent. Blocks of the training rows descend side by side from the same
weights and their steps are averaged, round by round; only weights travel, as a block makes its dual variables again from
the weights of the rounds before. A logistic curve over the margins of rows kept out of the fit turns margins into scores.

The fit reads every labelled row, in blocks of some BLOCK_ROWS (BLOCKS of them at least); every text is scored whole.

Nulls and edges: a null text is empty and an empty text is scored by the bias alone; rows without a usable label are not
learned from; repeated ids are learned once; with no labelled rows, or with one class only, every score is the smoothed
share of label 1. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.llm.common import discard, stored, text_of

BITS, SAME = 16, 8
DIMS = (1 << BITS) + SAME
BLOCKS, BLOCK_ROWS, SLABS, SLOTS = 8, 4096, 16, 1 << 24


def features(text: bytes) -> np.ndarray:
    """Sorted numbers of the indicators that are set."""
    words = text.split()
    run = max((len(list(g)) for same, g in groupby(map(bytes.__eq__, words[1:], words)) if same), default=0)
    repeats = np.arange(min(run, SAME), dtype=np.int32) + (1 << BITS)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return repeats
    code = (b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(2654435761) >> np.uint32(32 - BITS)
    code = np.sort(code.astype(np.uint16))
    return np.concatenate([code[np.concatenate([[True], code[1:] != code[:-1]])].astype(np.int32), repeats])


@dataclass
class Model:
    """weights: of the plain indicators, log-count ratios multiplied in; a, b: score = 1 / (1 + exp(-(a * margin + b)))."""

    weights: np.ndarray
    bias: float
    a: float
    b: float

    def margin(self, on: np.ndarray) -> float:
        return float(self.weights[on].sum()) + self.bias

    def score(self, text: bytes) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.a * self.margin(features(text)) + self.b, -500, 500))))


def descend(rows: list[tuple[np.ndarray, int]], alpha: np.ndarray, weights: np.ndarray, bias: float, ratio2: np.ndarray,
            cost: float, epochs: int) -> tuple[np.ndarray, np.ndarray, float]:
    """One block's dual coordinate descent; ``weights`` act on plain indicators, so a step adds ratio^2."""
    weights, alpha = weights.copy(), alpha.copy()
    norms = [float(ratio2[on].sum()) + 1.0 for on, _ in rows]
    for _ in range(epochs):
        for i, (on, y) in enumerate(rows):
            slope = y * (float(weights[on].sum()) + bias) - 1.0
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost)
            step = (new - alpha[i]) * y
            if step:
                weights[on] += step * ratio2[on]
                bias += step
                alpha[i] = new
    return alpha, weights, bias


def logistic(held: DataFrame) -> tuple[float, float]:
    """Slope and offset by Newton steps over the stored ``held`` (margin, label); targets are smoothed, so separable margins
    stay finite. Every step adds up a row of sums for each task, in the order of the tasks."""
    def summed(sums) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                total = total + np.array(sums(*(c.to_numpy() for c in batch.columns)))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
        return sum(np.frombuffer(bytes(r[0])) for r in held.mapInArrow(run, "sums binary").collect())  # one row per task

    n, pos, scale = summed(lambda m, y: [float(len(m)), float(y.sum()), np.abs(m).sum()])
    scale = float(scale / n) or 1.0
    high, low = (pos + 1) / (pos + 2), 1 / (n - pos + 2)
    a, b = 1.0, 0.0
    for _ in range(50):
        def sums(margin: np.ndarray, label: np.ndarray, a: float = a, b: float = b) -> list[float]:
            x = margin / scale
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            h = p * (1 - p) + 1e-6
            g = p - np.where(label == 1, high, low)
            return [(h * x * x).sum(), (h * x).sum(), h.sum(), (g * x).sum(), g.sum()]

        hxx, hx, h, gx, g = summed(sums)
        step = np.linalg.solve(np.array([[hxx + 1e-3, hx], [hx, h]]), np.array([gx + 1e-3 * a, g]))
        a, b = float(a - step[0]), float(b - step[1])
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-6) / scale, b


def _block(batches: Iterable[pa.RecordBatch]) -> tuple[int | None, list[tuple[np.ndarray, int]]]:
    """The least id of a task's rows to fit, and these in the order of their ids, so that every run descends alike."""
    rows = {}
    for batch in batches:
        for doc, label, fold, on in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if fold == 0:
                rows[doc] = np.frombuffer(on, np.int32), 2 * label - 1
    return min(rows, default=None), [rows[doc] for doc in sorted(rows)]


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the parts of each slab of the weights, and how many there are."""
    sums: dict[int, list] = {}
    for batch in batches:
        for slab, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            held = sums.setdefault(slab, [0, 0.0])
            held[0], held[1] = held[0] + 1, held[1] + np.frombuffer(part)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int32()),
                                      pa.array([v.tobytes() for _, v in sums.values()], pa.binary())], names=["slab", "blocks", "part"])


def _slot() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))


def marked(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The ``docs`` whose id is among the ``chosen``, and few others, by a bitmap of SLOTS bits: 2 MB however many ids."""
    bits = chosen.select(_slot().alias("s")).groupBy(F.bitmap_bucket_number("s").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__bits"))
    at = F.bitmap_bit_position(_slot())
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    found = docs.join(F.broadcast(bits), F.bitmap_bucket_number(_slot()) == F.col("__bucket"))
    return found.where(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1).select(*docs.columns)


def fit(docs: DataFrame, labels: DataFrame, rounds: int = 6, epochs: int = 2, cost: float = 0.05, smooth: float = 1.0) -> Model:
    """``labels`` (doc_id, label 0 or 1, calibrate): rows to learn from; those to calibrate with set only the curve."""
    spark = docs.sparkSession
    chosen = stored(labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
                    .agg(F.min("label").cast("int").alias("label"), F.min(F.col("calibrate").cast("int")).alias("fold")), "quality-labels")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = [features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(on, pa.binary())], names=["doc_id", "on"])

    texts = marked(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text")), chosen)
    rows = stored(texts.mapInArrow(read, "doc_id bigint, on binary").groupBy("doc_id").agg(F.min("on").alias("on"))
                  .join(chosen, "doc_id").select("doc_id", "label", "fold", "on")
                  .repartition(max(BLOCKS, -(-chosen.count() // BLOCK_ROWS)), "doc_id").sortWithinPartitions("doc_id"), "quality-rows")
    discard(chosen)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, DIMS), np.int64)
        n = np.zeros(2, np.int64)
        for batch in batches:
            for _, label, fold, on in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fold == 0:
                    seen[label, np.frombuffer(on, np.int32)] += 1
                    n[label] += 1
        used = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(seen[0, used], n[0])),
                                          pa.array(np.append(seen[1, used], n[1]))], names=["feature", "bad", "good"])

    counts = (rows.mapInArrow(count, "feature bigint, bad bigint, good bigint").groupBy("feature")
              .agg(F.sum("bad"), F.sum("good")).collect())  # at most DIMS + 1 rows
    seen, n = np.zeros((2, DIMS)), np.zeros(2)
    for feature, bad, good in counts:
        if feature < 0:
            n[:] = bad, good
        else:
            seen[:, feature] = bad, good
    if n.min() == 0:
        share = (n[1] + 1) / (n.sum() + 2)
        discard(rows)
        return Model(np.zeros(DIMS), 0.0, 1.0, float(np.log(share / (1 - share))))
    p = (seen + smooth) / (n[:, None] + 2 * smooth)
    ratio = np.log(p[1] / p[0])
    ratio2 = ratio * ratio
    began, blocks = [(np.zeros(DIMS), 0.0)], 1  # the weights each round began with

    for _ in range(rounds):
        state = spark.sparkContext.broadcast((began, blocks, ratio2))

        def step(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            began, blocks, ratio2 = state.value
            first, rows = _block(batches)
            if rows:
                alpha = np.zeros(len(rows))
                for weights, bias in began:  # the rounds before only for alpha
                    new, w, b = descend(rows, alpha, weights, bias, ratio2, cost, epochs)
                    alpha += (new - alpha) / blocks
                parts = np.array_split(np.append(w - weights, b - bias), SLABS)
                yield pa.RecordBatch.from_arrays([pa.array(range(SLABS), pa.int32()), pa.array([first] * SLABS, pa.int64()),
                                                  pa.array([v.tobytes() for v in parts], pa.binary())], names=["slab", "first", "part"])

        steps = (rows.mapInArrow(step, "slab int, first bigint, part binary").repartition("slab")
                 .sortWithinPartitions("slab", "first").mapInArrow(_added, "slab int, blocks int, part binary").collect())
        blocks = steps[0]["blocks"]
        move = np.concatenate([np.frombuffer(bytes(r["part"])) for r in sorted(steps)]) / blocks  # SLABS rows
        weights, bias = began[-1]
        began = [*began, (weights + move[:-1], bias + float(move[-1]))]
        state.unpersist()

    model = Model(*began[-1], 1.0, 0.0)

    def margins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(model.margin(np.frombuffer(on, np.int32)), label) for _, label, fold, on in
                   zip(*(c.to_pylist() for c in batch.columns), strict=True) if fold == 1]
            yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in got], pa.float64()),
                                              pa.array([y for _, y in got], pa.int32())], names=["margin", "label"])

    held = stored(rows.mapInArrow(margins, "margin double, label int"), "quality-margins")
    if held.select("label").distinct().count() == 2:
        model.a, model.b = logistic(held)
    discard(rows, held)
    return model


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of rows whose id checksum leaves 0, 1 or 3; those leaving 1 calibrate, those leaving 2 are never read."""
    kept = labels.select("doc_id", F.col("quality").alias("label"), remainder(F.col("doc_id")).alias("r"))
    return fit(docs, kept.where("r <> 2").select("doc_id", "label", (F.col("r") == 1).alias("calibrate")))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a last column ``quality_score`` of every whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            scores = pa.array([model.score((t.as_py() or "").encode()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "quality_score"])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))
