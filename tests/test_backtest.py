"""The refitted interaction ridge against numpy, fold by fold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from flowgrid.operators import backtest as B


def plain_fold(train, test, columns, effects, alpha):
    """The same ridge on an explicit design matrix."""
    fill = train[columns].mean().fillna(0)

    def design(d):
        hot = np.eye(24)[d.hour]
        parts = [hot] + [hot * d[[e]].fillna(0).to_numpy() for e in effects]
        return np.concatenate([d[columns].fillna(fill).to_numpy(), *parts], 1)

    x, y = design(train), train.y.to_numpy()
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-12] = np.inf
    z = (x - mean) / sd
    beta = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return y.mean() + (design(test) - mean) / sd @ beta


def test_refitted_folds_equal_numpy(spark):
    rng = np.random.default_rng(4)
    n, folds, size = 24 * 60, 12, 72
    h = np.arange(n)
    d = pd.DataFrame({"h": h, "hour": h % 24, "a": rng.normal(5, 2, n), "b": rng.normal(size=n), "off": (h // 24 % 7 >= 5) * 1.0, "heat": rng.gamma(2, 1, n)})
    d["y"] = 100 + 3 * d.a - d.b + 10 * np.sin(d.hour / 4) + d.off * d.hour + d.heat * (d.hour > 11) + rng.normal(size=n)
    d.loc[rng.random(n) < 0.1, "a"] = np.nan
    d.loc[rng.random(n) < 0.05, "heat"] = np.nan
    d["c"] = np.nan  # never known
    start = n - folds * size
    frame = spark.createDataFrame(d.astype(object).where(d.notna(), None), "h long, hour int, a double, b double, off double, heat double, y double, c double").repartition(5)
    at = F.floor((F.col("h") - start) / size)
    first = F.greatest(F.lit(0), F.floor((F.col("h") - start + 24) / size) + 1)
    columns, effects = ["a", "b", "c"], ["off", "heat"]
    got = B.interaction_backtest(frame, at, first, folds, columns, effects, alpha=3.0).toPandas().sort_values("h")
    assert len(got) == folds * size
    for f in range(folds):
        train, test = d[d.h < start + f * size - 24], d[(d.h >= start + f * size) & (d.h < start + (f + 1) * size)]
        mine = got[got.fold == f]
        assert (mine.n_train == len(train)).all()
        assert np.allclose(mine.pred, plain_fold(train, test, columns, effects, 3.0), rtol=1e-7), f


def test_backtest_of_few_or_no_rows(spark):
    frame = spark.createDataFrame([(1, 1, 2.0, 0.0, 3.0), (2, None, 1.0, 0.0, 3.0)], "h long, hour int, a double, off double, y double")
    none = B.interaction_backtest(frame, F.lit(0), F.lit(0), 2, ["a"], ["off"], least=2)
    assert none.count() == 0  # one row has an hour
    assert B.interaction_backtest(frame, F.lit(0), F.lit(0), 2, ["a"], ["off"], least=1).where("h = 1").first().pred == 3.0
    assert B.interaction_backtest(frame.limit(0), F.lit(0), F.lit(0), 2, ["a"], ["off"]).count() == 0
