"""Linear quantile regression from sums alone.

The pinball loss is smoothed over a width around zero (a logistic step in place of the jump), so that Newton's method
applies: each round solves reweighted normal equations whose sums one pass adds up for all groups and all levels at once;
only systems of the size of the design reach Python. The width shrinks with the rounds, from the scale of the residuals
to a fiftieth of it. Rows are stored once and read by every round; the coefficients of a round are a small table (a row
for each group) in the shared folder, so no plan grows with the rounds.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.operators.series import attach
from flowgrid.session import shared_folder


def _dot(beta: Column, x: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [beta[i] * c for i, c in enumerate(x)])


def _solved(sums: DataFrame, keys: list[str], p: int, levels: list[float], ridge: float, at_round: int) -> DataFrame:
    """The next coefficients: least squares in the first round, then a Newton step from ``old``."""
    def solve(batches):
        import pandas as pd

        for pdf in batches:
            out = {k: pdf[k] for k in keys}
            scale = pdf["scale"].to_numpy(float)
            for at in range(len(levels)):
                left, right = np.empty((len(pdf), p, p)), np.empty((len(pdf), p, 1))
                for i in range(p):
                    right[:, i, 0] = pdf[f"b{at}_{i}"]
                    for j in range(i, p):
                        left[:, i, j] = left[:, j, i] = pdf[f"a{at}_{i}_{j}"]
                size = np.maximum(np.sqrt(np.einsum("nii->ni", left)), 1e-150)  # columns of very different sizes
                left = left / size[:, :, None] / size[:, None, :] + ridge * np.eye(p)
                step = np.linalg.solve(left, right / size[..., None])[..., 0] / size
                if "old0" not in pdf:
                    rest = pdf["yy"].to_numpy(float) - (step * right[..., 0]).sum(1)
                    scale = 0.8 * np.sqrt(np.maximum(rest, 0) / pdf["n"].to_numpy(float)) + 1e-9 * np.sqrt(pdf["yy"].to_numpy(float) / pdf["n"].to_numpy(float))
                out[f"beta{at}"] = list(step if "old0" not in pdf else np.stack(pdf[f"old{at}"].to_numpy()) + step)
            scale = np.maximum(scale, 1e-300)
            yield pd.DataFrame({**out, "scale": scale, "width": scale * max(0.6**at_round, 0.02)})

    types = dict(sums.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], *[f"beta{a} array<double>" for a in range(len(levels))], "scale double", "width double"])
    return sums.mapInPandas(solve, schema)


def quantile_regression(df: DataFrame, keys: list[str], columns: list[str], label: str, levels: list[float], rounds: int = 9,
                        ridge: float = 1e-9) -> DataFrame:
    """keys, beta0, beta1, ... (one array for each level: intercept, then ``columns``), scale, the size of the first fit's
    residuals, and width, that of the last smoothing. Rows with a missing label or column teach nothing."""
    spark = df.sparkSession
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*columns, label)])
    names = [f"_x{i}" for i in range(len(columns))]
    path = shared_folder(spark, "quantile-regression")
    known = df.where(whole).select(*keys, *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)],
                           F.col(label).cast("double").alias("_y"))
    known.write.parquet(f"{path}/rows")
    rows = spark.read.schema(known.schema).parquet(f"{path}/rows")
    x, y = [F.lit(1.0), *[F.col(n) for n in names]], F.col("_y")
    cells = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    fit = None
    for at in range(rounds + 1):
        if fit is None:
            now, step = rows, [(F.lit(1.0), y)] * len(levels)
        else:
            now = attach(rows, fit, keys)  # broadcast if the table of coefficients is small
            width, step = F.col("width"), []  # a column, so that all rounds share their code
            for a, tau in enumerate(levels):
                below = 1 / (1 + F.exp(F.least(F.greatest((y - _dot(F.col(f"beta{a}"), x)) / width, F.lit(-500.0)), F.lit(500.0))))
                now = now.withColumn(f"_p{a}", below)
                p = F.col(f"_p{a}")
                step.append((p * (1 - p) / width, tau - p))
        sums = [F.count("*").alias("n"), F.sum(y * y).alias("yy"), *([F.first("scale").alias("scale")] if fit is not None else [F.lit(0.0).alias("scale")])]
        for a, (weight, pull) in enumerate(step):
            sums += [F.sum(weight * x[i] * x[j]).alias(f"a{a}_{i}_{j}") for i, j in cells]
            sums += [F.sum(pull * c).alias(f"b{a}_{i}") for i, c in enumerate(x)]
            if fit is not None:
                sums.append(F.first(f"beta{a}").alias(f"old{a}"))
        solved = _solved(now.groupBy(*keys).agg(*sums), keys, len(x), levels, ridge, at)
        solved.write.parquet(f"{path}/fit-{at}")
        fit = spark.read.schema(solved.schema).parquet(f"{path}/fit-{at}")
    return fit


def banded_by(df: DataFrame, fit: DataFrame, keys: list[str], columns: list[str], names: list[str]) -> DataFrame:
    """``df`` with the fitted quantile of each level under ``names``; crossing bands are put in order."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    out = attach(df, fit, keys).withColumns({n: _dot(F.col(f"beta{a}"), x) for a, n in enumerate(names)})
    betas = [c for c in fit.columns if c.startswith("beta")]
    ordered = F.array_sort(F.array(*names))
    return out.withColumns({n: ordered[a] for a, n in enumerate(names)}).drop(*betas, "scale", "width")
