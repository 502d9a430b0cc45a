"""Series operators against plain pandas on gappy data, with a chunk far smaller than the series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowgrid.operators import quantiles as Q
from flowgrid.operators import series as S

CHUNK = 37


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("hot", 900), ("small", 120), ("tiny", 3)):
        keep = rng.random(n) > 0.2
        x = np.round(rng.normal(100, 20, n), 2)
        rows += [(name, 1000 + i, float(x[i])) for i in range(n) if keep[i]]
    pdf = pd.DataFrame(rows, columns=["k", "h", "y"])
    return pdf, spark.createDataFrame(pdf).cache()


def full(pdf, k):
    s = pdf[pdf.k == k].set_index("h").y
    return s.reindex(range(s.index.min(), s.index.max() + 1))


def test_rolling_counts_positions_not_rows(gappy):
    pdf, df = gappy
    got = S.rolling(df, ["k"], "h", "y", 168, 48, 120, chunk=CHUNK).toPandas().set_index(["k", "h"])
    s = full(pdf, "hot")
    base = s.shift(48).rolling(168, min_periods=120)
    for h in pdf[pdf.k == "hot"].h:
        m, d = got.loc[("hot", h), ["roll_mean", "roll_std"]]
        assert (np.isnan(m) and np.isnan(base.mean()[h])) or np.isclose(m, base.mean()[h])
        assert (np.isnan(d) and np.isnan(base.std()[h])) or np.isclose(d, base.std()[h])


def test_lag_join_and_banded_lag_agree(gappy):
    pdf, df = gappy
    a = S.lag_join(df, df.select("k", "h", F.col("y").alias("v")), ["k"], "h", "v", {"l": 48}).select("k", "h", "l")
    b = S.banded(df, ["k"], "h", {"l": (-48, -48, lambda w: F.max("y").over(w))}, CHUNK).select("k", "h", "l")
    pa, pb = (x.toPandas().sort_values(["k", "h"]).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(pa, pb, check_dtype=False)
    s = full(pdf, "hot")
    want = s.shift(48)
    for _, r in pa[pa.k == "hot"].iterrows():
        assert (np.isnan(r.l) and np.isnan(want[r.h])) or r.l == want[r.h]


def test_interpolate_matches_pandas(gappy):
    pdf, df = gappy
    got = S.interpolate(S.on_grid(df, ["k"], "h"), ["k"], "h", "y", 2, chunk=CHUNK).toPandas()
    for k in ("hot", "small"):
        want = full(pdf, k).interpolate(limit=2)
        mine = got[got.k == k].set_index("h").filled.sort_index()
        np.testing.assert_allclose(mine.to_numpy(float), want.to_numpy(float), equal_nan=True)


def test_interpolate_repeats_the_last_value(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, None), (4, None)], "h int, y double")
    got = {r["h"]: r["filled"] for r in S.interpolate(df, [], "h", "y", 2, chunk=2).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 5.0, 4: None}


def test_centred_mean_even_window(gappy):
    pdf, df = gappy
    got = S.centred_mean(df, ["k"], "h", "y", 28, 14, "m", CHUNK).toPandas().set_index(["k", "h"]).m
    want = full(pdf, "hot").rolling(28, center=True, min_periods=14).mean()
    for h in pdf[pdf.k == "hot"].h:
        a, b = got[("hot", h)], want[h]
        assert (np.isnan(a) and np.isnan(b)) or np.isclose(a, b)


def test_runs_cross_chunks(spark):
    vals = [1, 1, 1, 2, 2, 1, 3, 3, 3, 3, 3, 4]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "h int, v int")
    tagged = S.runs(df, [], "h", F.col("v") != F.col("prev_v"), {"v": F.col("v")}, 2)
    got = sorted((r["run_start"], r["run_len"]) for r in S.run_lengths(tagged, [], "h").collect())
    assert got == [(0, 3), (3, 2), (5, 1), (6, 5), (11, 1)]


def test_stuck_needs_adjacent_hours(spark):
    rows = [(0, 5.0), (1, 5.0), (3, 5.0), (4, 7.0), (5, 7.0), (6, 7.0), (7, 7.0), (8, 1.0)]
    df = spark.createDataFrame(rows, "h int, y double")
    got = sorted(r["h"] for r in S.stuck(df, [], "h", "y", 3, 3).where("is_stuck").collect())
    assert got == [4, 5, 6, 7]


def test_acf_brute_force(gappy):
    pdf, df = gappy
    got = S.acf(df, ["k"], "h", "y", 30, CHUNK).where("k = 'hot'").toPandas().set_index("lag").r
    s = full(pdf, "hot")
    x = (s - s.mean()).fillna(0).to_numpy()
    for k in (0, 1, 7, 30):
        assert np.isclose(got[k], (x[:len(x) - k] * x[k:]).sum() / (x * x).sum())


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.8, 0.9, 1.0])
def test_exact_quantile_hot_and_tiny_groups(spark, q):
    rng = np.random.default_rng(5)
    pdf = pd.concat([pd.DataFrame({"k": "hot", "y": np.round(rng.exponential(50, 20000), 2)}),
                     pd.DataFrame({"k": "same", "y": [3.0] * 700}), pd.DataFrame({"k": "few", "y": [1.0, 2.0, 10.0]})])
    df = spark.createDataFrame(pdf)
    got = {r["k"]: r["q"] for r in Q.exact_quantile(df, ["k"], "y", q).collect()}
    for k, g in pdf.groupby("k"):
        assert np.isclose(got[k], np.quantile(g.y, q), atol=1e-9), k
    one = Q.exact_quantile(df, [], "y", q).first()["q"]
    assert np.isclose(one, np.quantile(pdf.y, q), atol=1e-9)


def test_per_series_equals_alone(gappy):
    _, df = gappy
    both = S.rolling(df, ["k"], "h", "y", 24, 2, 10, chunk=CHUNK).where("k = 'small'").drop("k")
    alone = S.rolling(df.where("k = 'small'").drop("k"), [], "h", "y", 24, 2, 10, chunk=CHUNK)
    a, b = (x.toPandas().sort_values("h").reset_index(drop=True) for x in (both, alone))
    pd.testing.assert_frame_equal(a, b)


@pytest.mark.parametrize("n", [1, 2, 9_999, 10_000, 10_001])
def test_quantiles_take_one_path_at_every_size(spark, n):
    rng = np.random.default_rng(n)
    y = np.concatenate([rng.standard_cauchy(n - n // 3), np.full(n // 3, 7.0)])  # heavy tails, and a third of equal values
    df = spark.createDataFrame(pd.DataFrame({"y": y})).unionByName(spark.sql("SELECT double('nan') AS y UNION ALL SELECT null"))
    qs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 0.999, "f": 1.0}
    got = Q.exact_quantiles(df, [], "y", qs).first()
    for k, q in qs.items():
        assert np.isclose(got[k], np.quantile(y, q), rtol=1e-12, atol=1e-12), (k, n)


def test_more_quantiles_cost_no_more_scans(spark, tmp_path):
    spark.range(5000).selectExpr("id % 3 AS k", "CAST(hash(id) AS DOUBLE) AS y").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    scans = lambda qs: Q.exact_quantiles(df, ["k"], "y", qs)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans({"a": 0.5}) == scans({"a": 0.1, "b": 0.5, "c": 0.9})


def test_quantiles_of_earlier_folds_without_copies(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 6000), "f": rng.integers(0, 9, 6000), "y": np.round(rng.lognormal(0, 2, 6000), 2)})
    pdf.loc[pdf.f == 4, "y"] = np.nan
    got = Q.exact_quantiles(spark.createDataFrame(pdf), ["k"], "y", {"lo": 0.1, "hi": 0.8}, "f")
    rows = {(r.k, r.f): (r.lo, r.hi) for r in got.collect()}
    want = {(k, f): tuple(np.nanquantile(pdf.y[(pdf.k == k) & (pdf.f < f)], [0.1, 0.8])) for k in "ab" for f in range(1, 9)}
    assert rows.keys() == want.keys() and all(np.allclose(rows[k], want[k], rtol=1e-12) for k in want)
    assert Q.exact_quantiles(spark.createDataFrame(pdf).limit(0), ["k"], "y", {"lo": 0.1}, "f").count() == 0
