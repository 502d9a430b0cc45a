"""Runs, sliding means and the hinge scan: plain versions and plans."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowgrid.operators import explore as X
from flowgrid.operators import series as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k, n in (("hot", 1500), ("small", 90), (None, 40), ("one", 1)):
        at = np.sort(rng.choice(np.arange(3 * n), n, replace=False)) + 500
        rows += [(k, int(p), int(v)) for p, v in zip(at, rng.integers(0, 3, n), strict=True)]
    return rows, spark.createDataFrame(rows, "k string, h long, v long").repartition(6)


@pytest.mark.parametrize("chunk", [16, 37, 10_000])
def test_runs_equal_a_plain_loop(gappy, chunk):
    rows, df = gappy
    breaks = (F.col("v") != F.col("prev_v")) | (F.col("h") - F.col("prev_p") > 3)
    got = {(r.k, r.h): r.run_start for r in S.runs(df, ["k"], "h", breaks, {"v": F.col("v"), "p": F.col("h")}, chunk).collect()}
    want, last = {}, {}
    for k, h, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        start, p, old = last.get(k, (h, h, None))
        start = h if old is None or v != old or h - p > 3 else start
        want[k, h], last[k] = start, (start, h, v)
    assert got == want


def test_runs_shuffle_their_rows_once(spark, tmp_path):
    spark.range(2000).selectExpr("CAST(id % 3 AS STRING) AS k", "id AS h", "id % 7 AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(S.runs(df, ["k"], "h", F.col("v") != F.col("prev_v"), {"v": F.col("v")}, 100))
    assert text.count("FileScan") <= 2 and text.count("Exchange hashpartitioning") <= 4  # rows by chunk (twice: rows and summary) and two of summaries


@pytest.mark.parametrize("lo,hi", [(-5, 4), (-30, -2), (0, 0), (3, 40)])
def test_sliding_sums_equal_frames(gappy, lo, hi):
    rows, df = gappy
    df = df.withColumn("y", F.when(F.col("v") > 0, F.col("v") * 1000.0 + F.col("h") % 17))
    mine = S.sliding(df, ["k"], "h", "y", lo, hi, 37)
    frames = {"n": (lo, hi, lambda w: F.count("y").over(w)), "m": (lo, hi, lambda w: F.avg("y").over(w)), "s": (lo, hi, lambda w: F.stddev_samp("y").over(w))}
    want = S.banded(df, ["k"], "h", frames, 37)
    a, b = (x.orderBy("k", "h").toPandas() for x in (mine, want))
    assert (a._n == b.n).all() and np.allclose(a._m.astype(float), b.m.astype(float), equal_nan=True) and np.allclose(a._s.astype(float), b.s.astype(float), atol=1e-6, equal_nan=True)


def test_sliding_takes_flat_and_missing_values(spark):
    rows = [(h, 1e6 + 0.1 if h < 60 else float("nan") if h == 70 else None if h == 71 else float(h)) for h in range(100)]
    got = {r.h: r for r in S.sliding(spark.createDataFrame(rows, "h long, y double"), [], "h", "y", -9, 0, 64).collect()}
    assert got[40]._s == 0 and got[40]._n == 10 and abs(got[40]._m - 1e6 - 0.1) < 1e-6
    assert got[75]._n == 8 and abs(got[75]._m - np.mean([66, 67, 68, 69, 72, 73, 74, 75])) < 1e-9


def test_hinge_scan_equals_least_squares_without_fan_out(spark):
    rng = np.random.default_rng(9)
    d = pd.DataFrame({"x": np.r_[rng.uniform(10, 40, 800), 20.0, 21.5], "y": 0.0})
    d["y"] = 50 + 3 * np.maximum(d.x - 24.4, 0) + rng.normal(size=len(d))
    df = spark.createDataFrame(d).unionByName(spark.sql("SELECT CAST(null AS DOUBLE) AS x, 1D AS y UNION ALL SELECT 1D, null"))
    scan = X.hinge_scan(df, "x", "y", 18, 32, 0.1)
    assert "Generate" not in plan(scan) and "BroadcastNestedLoop" not in plan(scan)
    got = scan.toPandas().set_index("knot")
    assert len(got) == 141 and abs(got.sse.idxmin() - 24.4) < 1
    for knot in (18.0, 24.4, 31.9):
        z = np.column_stack([np.ones(len(d)), np.maximum(d.x - knot, 0)])
        beta, sse, *_ = np.linalg.lstsq(z, d.y, rcond=None)
        assert np.isclose(got.sse[knot], sse[0]) and np.isclose(got.slope[knot], beta[1])
    assert X.hinge_scan(df.limit(0), "x", "y", 18, 32, 0.1).count() == 0


def test_hinge_knots_below_every_row_fit_alike(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(24.05, 90, 700)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, 5000 - 28 * x + rng.normal(0, 1, 700), strict=True)], "x double, y double")
    scan = X.hinge_scan(df, "x", "y", 18, 32, 0.1).toPandas()
    assert scan[scan.knot <= 24].sse.nunique() == 1 and scan[scan.knot >= 24.2].sse.nunique() == 79
    assert scan.sort_values(["sse", "knot"]).knot.iloc[0] == 18


def test_bins_keep_what_lies_outside(spark):
    df = spark.createDataFrame([(-5.0, 1.0), (0.0, 2.0), (0.5, 3.0), (20.0, 4.0), (99.0, 5.0), (None, 6.0)], "x double, y double")
    assert {r.bin: r.n for r in X.binned(df, "x", "y", 0, 10, 2).collect()} == {-1: 2, 0: 1, 1: 1, 2: 1}
