"""Quantile regression: subgradient condition, known coefficients, groups as alone."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from flowgrid.operators import quantreg as QR


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    n = 4000
    d = pd.DataFrame({"k": rng.choice(["a", "b"], n, p=[0.8, 0.2]), "u": rng.uniform(0, 10, n), "v": rng.normal(50, 5, n)})
    d["y"] = np.where(d.k == "a", 3, -7) + 2 * d.u + 0.5 * d.v + (1 + 0.3 * d.u) * rng.exponential(2, n)
    extra = pd.DataFrame({"k": ["a", None], "u": [None, 1.0], "v": [1.0, None], "y": [5.0, 1.0]})
    return d, spark.createDataFrame(d).unionByName(spark.createDataFrame(extra.astype(object).where(extra.notna(), None), "k string, u double, v double, y double"))


def test_fits_meet_the_subgradient_condition(spark, data):
    d, df = data
    levels = [0.1, 0.5, 0.9]
    fit = {r.k: r for r in QR.quantile_regression(df, ["k"], ["u", "v"], "y", levels).collect()}
    assert set(fit) == {"a", "b"}
    for k, g in d.groupby("k"):
        x = np.column_stack([np.ones(len(g)), g.u, g.v])
        for a, tau in enumerate(levels):
            r = g.y.to_numpy() - x @ np.array(fit[k][f"beta{a}"])
            slack = np.abs(((tau - (r < 0))[:, None] * x).mean(0)) / np.abs(x).mean(0)  # zero at the optimum, up to a few rows
            assert (slack < 0.01).all(), (k, tau, slack)
            assert abs((r < 0).mean() - tau) < 0.01
    slope = fit["a"]["beta2"][1] - fit["a"]["beta0"][1]
    assert abs(slope - 0.6 * np.log(9)) < 0.25  # the spread grows with u


def test_bands_are_ordered_and_follow_the_group(spark, data):
    d, df = data
    fit = QR.quantile_regression(df, ["k"], ["u"], "y", [0.1, 0.9], rounds=8)
    band = QR.banded_by(df.where("y is not null and u is not null"), fit, ["k"], ["u"], ["lo", "hi"]).toPandas()
    assert len(band) == len(d) + 1 and (band.lo <= band.hi).all() and list(band.columns) == ["k", "u", "v", "y", "lo", "hi"]
    inside = ((band.y >= band.lo) & (band.y <= band.hi)).groupby(band.k).mean()
    assert (abs(inside[["a", "b"]] - 0.8) < 0.03).all()
