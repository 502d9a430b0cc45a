"""A backtest whose interaction ridge is fitted anew for every fold, from one pass over the training rows.

A ridge needs only sums of products. Rows are added up once, by the first fold that may learn from them and by hour of
day; running totals over folds are the training sums of every fold. The design has, beside the plain columns, a one-hot of
the hour and its products with a few effects. Of these 24 x (1 + effects) columns only those of the row's own hour are
not zero, so the sums of an hour are one small block, and the matrix of a fold is put together from 24 blocks.

Missing values take the mean of the fold's training rows: their sums and counts are part of the blocks, so no pass of
its own is needed. Fits see folds x 24 blocks, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURS = 24
BLOCK = "first int, hour int, gram binary"


def _wide(x: np.ndarray, effects: int) -> np.ndarray:
    """Rows [1, values or 0, missing, effects or 0, label] of rows [values, effects, label]."""
    p = x.shape[1] - effects - 1
    gone = np.isnan(x)
    known = np.where(gone, 0.0, x)
    return np.concatenate([np.ones((len(x), 1)), known[:, :p], gone[:, :p], known[:, p:]], 1)


def _blocks(effects: int):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            first, hour = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[2:]])
            wide = _wide(x, effects)
            for key in {*zip(first.tolist(), hour.tolist(), strict=True)}:
                rows = wide[(first == key[0]) & (hour == key[1])]
                sums[key] = sums.get(key, 0) + rows.T @ rows
        yield _packed(sums)
    return add


def _packed(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                                       pa.array([g.tobytes() for g in sums.values()], pa.binary())], names=["first", "hour", "gram"])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for first, hour, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums[first, hour] = sums.get((first, hour), 0) + np.frombuffer(raw)
    yield _packed(sums)


def solve(blocks: np.ndarray, p: int, alpha: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients, fills, intercept) of the ridge on standardised columns from the blocks of the 24 hours. Columns: p plain
    ones, then for each hour its one-hot and effects."""
    k = blocks.shape[1] - 2 * p - 2
    total = blocks.sum(0)
    known = total[0, 0] - total[0, 1 + p:1 + 2 * p]
    fill = np.divide(total[0, 1:1 + p], known, out=np.zeros(p), where=known > 0)
    turn = np.zeros((2 * p + k + 2, p + k + 2))  # [1, x, missing, effects, y] -> [1, filled x, effects, y]
    turn[0, 0] = 1
    turn[1:1 + p, 1:1 + p] = np.eye(p)
    turn[1 + p:1 + 2 * p, 1:1 + p] = np.diag(fill)
    turn[1 + 2 * p:, 1 + p:] = np.eye(k + 1)
    small = turn.T @ blocks @ turn
    size = p + HOURS * (1 + k)
    gram, own = np.zeros((size + 2, size + 2)), [0, *range(1 + p, 1 + p + k)]  # [1, columns, y]
    plain = [*range(1 + p), size + 1]
    gram[np.ix_(plain, plain)] = small.sum(0)[np.ix_([*range(1 + p), -1], [*range(1 + p), -1])]
    for h in range(HOURS):
        at = [1 + p + h * (1 + k) + i for i in range(1 + k)]
        gram[np.ix_(at, at)] = small[h][np.ix_(own, own)]
        gram[np.ix_(at, plain)] = small[h][np.ix_(own, [*range(1 + p), -1])]
        gram[np.ix_(plain, at)] = gram[np.ix_(at, plain)].T
    n = gram[0, 0]
    mean = gram[0] / n
    cov = gram - n * np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[1:-1], 0) / n)
    inv = np.divide(1.0, sd, out=np.zeros(size), where=sd > 1e-9 * np.maximum(1.0, np.abs(mean[1:-1])))
    left = cov[1:-1, 1:-1] * inv[:, None] * inv + alpha * np.eye(size)
    beta = np.linalg.solve(left, cov[1:-1, -1] * inv) * inv
    return beta, fill, float(mean[-1] - beta @ mean[1:-1])


def _fits(p: int, alpha: float, least: int, folds: list[int]):
    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for first, hour, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                flat = np.frombuffer(raw)
                parts.setdefault(first, {})[hour] = flat.reshape(int(len(flat) ** 0.5), -1)
        if not parts:
            return
        side = next(iter(next(iter(parts.values())).values())).shape[0]
        total = np.zeros((HOURS, side, side))
        out = []
        for f in folds:
            for first in sorted(k for k in parts if k <= f):
                for hour, gram in parts.pop(first).items():
                    total[hour] += gram
            if total[:, 0, 0].sum() >= least:
                beta, fill, base = solve(total, p, alpha)
                out.append({"fold": f, "n_train": int(total[:, 0, 0].sum()), "base": base, "fill": fill.tolist(), "plain": beta[:p].tolist(),
                            "hours": beta[p:].reshape(HOURS, -1).tolist()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("fold", pa.int32()), ("n_train", pa.int64()), ("base", pa.float64()), ("fill", pa.list_(pa.float64())),
                                                         ("plain", pa.list_(pa.float64())), ("hours", pa.list_(pa.list_(pa.float64())))]))
    return fit


def interaction_fits(df: DataFrame, first: Column, folds: int, columns: list[str], effects: list[str], label: str = "y", hour: str = "hour",
                     alpha: float = 3.0, least: int = 200) -> DataFrame:
    """fold, n_train, base, fill, plain, hours: the ridge of folds 0 .. ``folds`` - 1, each on the rows whose ``first`` fold is not
    later. Rows without a label, hour or first fold teach nothing; folds with fewer than ``least`` rows have no fit."""
    numbers = [F.col(c).cast("double") for c in (*columns, *effects, label)]
    rows = df.where(F.col(label).isNotNull() & F.col(hour).isNotNull() & first.isNotNull()).select(
        first.cast("int").alias("first"), F.col(hour).cast("int").alias("hour"), *[c.alias(f"_{i}") for i, c in enumerate(numbers)])
    blocks = rows.mapInArrow(_blocks(len(effects)), BLOCK)
    some = blocks.repartition("first", "hour").mapInArrow(_added, BLOCK)  # a block of each task and hour
    return some.coalesce(1).mapInArrow(_fits(len(columns), alpha, least, list(range(folds))),
                                       "fold int, n_train bigint, base double, fill array<double>, plain array<double>, hours array<array<double>>")


def interaction_backtest(df: DataFrame, fold: Column, first: Column, folds: int, columns: list[str], effects: list[str], label: str = "y",
                         hour: str = "hour", alpha: float = 3.0, least: int = 200) -> DataFrame:
    """The rows of ``df`` in a test ``fold`` with ``fold``, ``n_train`` and ``pred`` of that fold's own fit."""
    fits = interaction_fits(df, first, folds, columns, effects, label, hour, alpha, least)
    rows = df.withColumn("fold", fold.cast("int")).where(F.col("fold").between(0, folds - 1))
    both = rows.join(F.broadcast(fits), "fold")  # a row for each fold
    pred = F.col("base") + F.col("hours")[F.col(hour).cast("int")][0]
    for i, c in enumerate(columns):
        pred = pred + F.col("plain")[i] * F.coalesce(F.col(c).cast("double"), F.col("fill")[i])
    for i, c in enumerate(effects):
        pred = pred + F.col("hours")[F.col(hour).cast("int")][i + 1] * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return both.withColumn("pred", pred).drop("base", "fill", "plain", "hours")
