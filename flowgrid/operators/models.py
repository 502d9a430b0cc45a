"""Model families on Spark ML.

Every family trains as a distributed job over the pooled feature table: the level of each series is taken out by its
own growth trend, so one set of coefficients serves all series, and a table of one series gives the single-site model.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, Interaction, OneHotEncoder, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid import config as C
from flowgrid.functions.timefns import day_of_hour
from flowgrid.operators.features import FEATURES, LEVEL_FEATURES, MODEL_COLUMNS, TREND_FEATURE
from flowgrid.operators.series import attach
from flowgrid.session import shared_folder

# Raw integers a linear model must not see.
LINEAR_EXCLUDE = ("hour", "day_of_week", "month", TREND_FEATURE)
INTERACTION_ALPHA = 3.0
YEAR = 365.25


# ---- seasonal naive --------------------------------------------------------------------------------------------
def seasonal_naive(first: str = "lag_168h", second: str = "same_hour_mean_3w", default: Column | None = None) -> Column:
    """The lag, else the fallback feature, else a constant (the training mean)."""
    last = F.lit(None).cast("double") if default is None else default
    return F.coalesce(F.col(first), F.col(second), last)


# ---- growth trend ----------------------------------------------------------------------------------------------
TREND_TERMS = ["one", "t", "s1", "c1", "s2", "c2"]


def growth_trend(df: DataFrame, keys: list[str], t: str = TREND_FEATURE, y: str = "y",
                 least_days: int = C.MIN_GROWTH_DAYS) -> DataFrame:
    """keys, intercept, slope of ln(daily mean) on t with two annual harmonics; slope 0 on histories shorter than
    ``least_days`` or with fewer days than terms. Days that do not tell the terms apart get the least-squares solution
    of smallest norm.

    All series at once: the normal equations are plain sums (t is shifted by the series mean and scaled to years so
    that they stay well conditioned), and only the 6 x 6 system of a series reaches Python.
    """
    daily = df.groupBy(*keys, F.floor(t).cast("double").alias("t")).agg(F.avg(y).alias("y")).where(F.col("y") > 0)
    ends = daily.groupBy(*keys).agg(F.avg("t").alias("_mid"), (F.max("t") - F.min("t")).alias("_span"))
    d = attach(daily, ends, keys)
    w = F.col("t") * F.lit(2 * math.pi / YEAR)
    terms = {"one": F.lit(1.0), "t": (F.col("t") - F.col("_mid")) / F.lit(YEAR), "s1": F.sin(w), "c1": F.cos(w),
             "s2": F.sin(2 * w), "c2": F.cos(2 * w), "ly": F.log("y")}
    d = d.select(*keys, "_mid", "_span", *[e.alias(n) for n, e in terms.items()])
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = d.groupBy(*keys).agg(F.first("_mid").alias("_mid"), F.first("_span").alias("_span"),
                                F.avg("ly").alias("_mean"), F.count("ly").alias("_days"),
                                *[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a, b in pairs])

    def solve(batches):
        for pdf in batches:
            a = np.empty((len(pdf), 6, 6))
            b = np.empty((len(pdf), 6))
            for i, p in enumerate(TREND_TERMS):
                b[:, i] = pdf[f"{p}_ly"]
                for j, q in enumerate(TREND_TERMS):
                    a[:, i, j] = pdf[f"{p}_{q}"] if f"{p}_{q}" in pdf else pdf[f"{q}_{p}"]
            slope, icept = np.zeros(len(pdf)), pdf["_mean"].to_numpy(float).copy()
            long = (pdf["_span"].to_numpy(float) >= least_days) & (pdf["_days"].to_numpy() >= len(TREND_TERMS))
            if long.any():
                beta = (np.linalg.pinv(a[long], rcond=1e-12, hermitian=True) @ b[long][..., None])[..., 0]
                slope[long] = beta[:, 1] / YEAR
                icept[long] = beta[:, 0] - slope[long] * pdf["_mid"].to_numpy(float)[long]
            yield pdf[keys].assign(intercept=icept, slope=slope)

    types = dict(sums.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "intercept double", "slope double"])
    return sums.mapInPandas(solve, schema)


def trend_level(t: str = TREND_FEATURE) -> Column:
    return F.exp(F.col("intercept") + F.col("slope") * F.col(t))


def annual_growth_pct() -> Column:
    return F.expm1(F.col("slope") * 365) * 100


def normalise(df: DataFrame, trend: DataFrame, keys: list[str], label: str | None = "y") -> DataFrame:
    """Divide the target and every level feature by the series' trend at the target hour -> ``trend`` column kept."""
    out = attach(df, trend, keys).withColumn("trend", trend_level())
    names = [c for c in LEVEL_FEATURES if c in df.columns] + ([label] if label and label in df.columns else [])
    return out.withColumns({c: F.col(c) / F.col("trend") for c in names}).drop("intercept", "slope")


# ---- linear ----------------------------------------------------------------------------------------------------
def ridge_penalty(df: DataFrame, label: str, alpha: float) -> float:
    """The regParam that makes ``LinearRegression`` solve min |y - Xb|^2 + alpha |b|^2 on standardised features.

    Spark averages the squared error over the rows and scales the label by its deviation, hence
    regParam = alpha * sd(y) / n.
    """
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return alpha * (row["s"] or 0.0) / max(row["n"], 1)


def linear_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in LINEAR_EXCLUDE]


def filled(columns: list[str]) -> list[str]:
    return [f"{c}__f" for c in columns]


def ridge(df: DataFrame, columns: list[str], label: str, alpha: float = 1.0, interactions: bool = False,
          rank_error: float = 0.0) -> PipelineModel:
    """Median impute -> standardise -> ridge; optionally with hour one-hots and hour x (day off, Ramadan, cooling).

    Columns that are null throughout carry nothing and are left out.
    """
    seen = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    base = [c for c in linear_columns(columns) if seen[c]]
    stages = [Imputer(strategy="median", inputCols=base, outputCols=filled(base), relativeError=rank_error)]
    parts = filled(base)
    if interactions:
        stages.append(OneHotEncoder(inputCols=["hour"], outputCols=["hour_hot"], dropLast=False))
        parts = [*parts, "hour_hot"]
        for c in ("is_day_off", "is_ramadan", "fc_cdd24_hour__0"):
            stages.append(Interaction(inputCols=["hour_hot", c], outputCol=f"hour_x_{c}"))
            parts.append(f"hour_x_{c}")
    stages.append(VectorAssembler(inputCols=parts, outputCol="x", handleInvalid="error"))
    stages.append(LinearRegression(featuresCol="x", labelCol=label, predictionCol="raw", solver="normal",
                                   elasticNetParam=0.0, standardization=True, regParam=ridge_penalty(df, label, alpha)))
    return Pipeline(stages=stages).fit(design(df))


def design(df: DataFrame) -> DataFrame:
    """Inputs of the interaction terms: a missing cooling degree counts as zero there."""
    if "fc_cdd24_hour" in df.columns:
        df = df.withColumn("fc_cdd24_hour__0", F.coalesce("fc_cdd24_hour", F.lit(0.0)))
    return df


# ---- trees -----------------------------------------------------------------------------------------------------
def trees(df: DataFrame, columns: list[str], label: str, kind: str = "gbt", params: dict | None = None,
          rank_error: float = 0.0) -> PipelineModel:
    """Gradient-boosted trees or a random forest on imputed features."""
    seen = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    base = [c for c in columns if c != TREND_FEATURE and seen[c]]
    stages = [Imputer(strategy="median", inputCols=base, outputCols=filled(base), relativeError=rank_error),
              VectorAssembler(inputCols=filled(base), outputCol="x")]
    common = {"featuresCol": "x", "labelCol": label, "predictionCol": "raw"}
    if kind == "gbt":
        chosen = {"maxIter": 40, "stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.8,
                  "featureSubsetStrategy": "0.8", "seed": 42, **(params or {})}
        stages.append(GBTRegressor(**common, **chosen))
    else:
        chosen = {"numTrees": 200, "minInstancesPerNode": 5, "featureSubsetStrategy": "0.5", "seed": 42,
                  **(params or {})}
        stages.append(RandomForestRegressor(**common, **chosen))
    return Pipeline(stages=stages).fit(df)


def importance(model: PipelineModel) -> list[tuple[str, float]]:
    """Split gain per feature of a fitted tree pipeline, largest first (model metadata, not data)."""
    names = [c.removesuffix("__f") for c in model.stages[-2].getInputCols()]
    gain = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, gain)), key=lambda p: (-p[1], p[0]))


# ---- families --------------------------------------------------------------------------------------------------
class Fitted:
    """A fitted family: how to add ``pred`` to a feature frame."""

    def __init__(self, family: str, keys: list[str], parts: dict, trend: DataFrame | None = None,
                 default: float | None = None, lag: str | None = None):
        self.family, self.keys, self.parts, self.trend, self.default, self.lag = family, keys, parts, trend, default, lag

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``pred``; members of a blend are scored side by side in one pass."""
        if self.lag:
            return df.withColumn("pred", seasonal_naive(self.lag, default=F.lit(self.default)))
        out, preds = df, []
        names = [c for c in LEVEL_FEATURES if c in df.columns]
        if self.trend is not None:
            out = attach(out, self.trend, self.keys).withColumn("trend", trend_level())
            keep = {c: f"{c}__raw" for c in names}
            out = out.withColumnsRenamed(keep).withColumns({c: F.col(k) / F.col("trend") for c, k in keep.items()})
        for name, model in self.parts.items():
            out = model.transform(design(out))
            scaled = F.col("raw") * F.col("trend") if self.trend is not None else F.col("raw")
            made = [c for c in out.columns if c.endswith("__f") or c in ("x", "raw", "hour_hot", "fc_cdd24_hour__0")
                    or c.startswith("hour_x_")]
            out = out.withColumn(f"pred_{name}", scaled).drop(*made)
            preds.append(f"pred_{name}")
        if self.trend is not None:
            out = out.drop(*names).withColumnsRenamed({f"{c}__raw": c for c in names})
        total = sum((F.col(p) for p in preds[1:]), F.col(preds[0]))
        return out.withColumn("pred", total / len(preds)).select(*df.columns, "pred")


FAMILIES = ("seasonal_naive_168", "seasonal_naive_48", "ridge_fourier", "gbt", "gbt_trend", "ridge_interactions",
            "blend_ridge_gbt")


#: The models of the families on the detrended target.
TRENDED = {"gbt_trend": ("gbt",), "ridge_interactions": ("ridge",), "blend_ridge_gbt": ("gbt", "ridge"),
           "random_forest_trend": ("forest",)}


def fit(family: str, df: DataFrame, keys: list[str], label: str = "y", ridge_alpha: float = 1.0,
        gbt: dict | None = None, columns: list[str] | None = None, rank_error: float = 0.0) -> Fitted:
    """Fit a family by name on a feature frame with a label; an unknown name raises."""
    return fit_all([family], df, keys, label, ridge_alpha, gbt, columns, rank_error)[family]


def fit_all(families, df: DataFrame, keys: list[str], label: str = "y", ridge_alpha: float = 1.0,
            gbt: dict | None = None, columns: list[str] | None = None, rank_error: float = 0.0) -> dict[str, Fitted]:
    """Fit every family by name. Those on the detrended target share one trend and one table, and a model that several of
    them hold (a blend and its members) is fitted once: rows, parameters and seed are the same."""
    columns = columns or MODEL_COLUMNS
    out: dict[str, Fitted] = {}
    trend = z = None
    made: dict[str, PipelineModel] = {}
    for family in families:
        if family in ("seasonal_naive_168", "seasonal_naive_48"):
            mean = df.agg(F.avg(label).alias("m")).first()["m"]
            out[family] = Fitted(family, keys, {}, default=mean, lag="lag_168h" if family.endswith("168") else "lag_48h")
        elif family == "ridge_fourier":
            out[family] = Fitted(family, keys, {"ridge": ridge(df, columns, label, ridge_alpha, rank_error=rank_error)})
        elif family == "gbt":
            out[family] = Fitted(family, keys, {"gbt": trees(df, columns, label, "gbt", gbt, rank_error)})
        elif family in TRENDED:
            if trend is None:
                trend = growth_trend(df.withColumnRenamed(label, "y"), keys)
                path = shared_folder(df.sparkSession, "trend")  # a row per series, read again by every prediction
                trend.write.parquet(path)
                trend = df.sparkSession.read.schema(trend.schema).parquet(path)
                z = normalise(df, trend, keys, label).cache()
            for part in TRENDED[family]:
                if part not in made:
                    made[part] = (ridge(z, columns, label, INTERACTION_ALPHA, True, rank_error) if part == "ridge" else
                                  trees(z, columns, label, part, gbt, rank_error))
            out[family] = Fitted(family, keys, {part: made[part] for part in TRENDED[family]}, trend)
        else:
            raise ValueError(f"unknown model family {family!r}")
    if z is not None:
        z.unpersist()
    return out


def permuted(df: DataFrame, row_id: list[str], columns: list[str], seeds: list[int], bucket_rows: int = 20_000) -> DataFrame:
    """Every row of ``df`` once for each seed (``_seed``), with ``_other``: the ``columns`` of the row that the seed's permutation
    puts in its place. All permutations are one table, made without a global sort.

    Rows are numbered twice inside hash buckets - once by a seeded hash of the row id, once by an independent one - and
    the k-th row of one order takes the columns of the k-th row of the other. Bucket sizes differ, so ranks are made
    global with the offsets of the buckets, one row for ``bucket_rows`` and seed.
    """
    from pyspark.sql import Window

    buckets = -(-df.count() // bucket_rows) or 1
    each = F.explode(F.array(*[F.lit(s) for s in seeds])).alias("_seed")

    def ranked(side: DataFrame, salt: int) -> DataFrame:
        h = F.xxhash64(*row_id, F.col("_seed") * 2 + salt)
        b = side.select("*", each).withColumn("_h", h).withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)))
        size = b.groupBy("_seed", "_b").agg(F.count("*").alias("_n"))
        off = size.select("_seed", "_b", (F.sum("_n").over(Window.partitionBy("_seed").orderBy("_b")) - F.col("_n")).alias("_off"))
        rn = F.row_number().over(Window.partitionBy("_seed", "_b").orderBy("_h", *row_id))
        return b.withColumn("_rn", rn).join(off, ["_seed", "_b"]).withColumn("_k", F.col("_rn") + F.col("_off")).drop("_h", "_b", "_rn", "_off")

    right = ranked(df.select(*row_id, *[c for c in columns if c not in row_id]), 2).select("_seed", "_k", F.struct(*columns).alias("_other"))
    return ranked(df, 1).join(right, ["_seed", "_k"]).select(*df.columns, "_seed", "_other")


def permute_group(df: DataFrame, row_id: list[str], columns: list[str], seed: int, bucket_rows: int = 20_000) -> DataFrame:
    """Shuffle a group of columns jointly between rows."""
    both = permuted(df, row_id, columns, [seed], bucket_rows)
    return both.select(*[F.col("_other")[c].alias(c) if c in columns else F.col(c) for c in df.columns])


def permutation_importance(model: Fitted, df: DataFrame, row_id: list[str], groups: dict[str, list[str]],
                           repeats: int = 3) -> list[tuple[str, float]]:
    """Mean rise of the MAPE when a group of features is shuffled jointly, largest first.

    All repeats come from one table of permutations. A row is scored once for each repeat and group, with the other row's
    values in the columns of that group alone, and everything is added up in one aggregate. Groups share no column.
    """
    from flowgrid.operators.evaluate import mape

    owner = {c: name for name, cols in groups.items() for c in cols}
    base = model.predict(df).agg(mape().alias("m")).first()["m"]
    rows = permuted(df, row_id, list(owner), list(range(repeats))).withColumn("_group", F.explode(F.array(*[F.lit(g) for g in groups])))
    swapped = rows.select("_seed", "_group", *[F.when(F.col("_group") == owner[c], F.col("_other")[c]).otherwise(F.col(c)).alias(c)
                                               if c in owner else F.col(c) for c in df.columns])
    scores = model.predict(swapped).groupBy("_group", "_seed").agg(mape().alias("m")).groupBy("_group").agg(F.avg("m").alias("m")).collect()
    return sorted(((r["_group"], r["m"] - base) for r in scores), key=lambda p: -p[1])


# Names of the groups whose joint shuffle is reported, each with the stems of its features; a feature
# belongs to the first group that has a stem of it.
GROUP_STEMS = [
    ("lags", ("lag_",)), ("rolling level", ("roll_", "same_hour")), ("temperature persistence", ("fc_tmean_prev", "obs_")),
    ("weather forecast", ("fc_",)), ("daily shape", ("hour",)), ("weekday", ("day_of_week", "is_weekend", "is_day_off", "dow_")),
    ("holidays", ("is_holiday", "day_before", "day_after", "is_eid")), ("Ramadan", ("is_ramadan", "ramadan")),
    ("season", ("month", "doy_")), ("school break and events", ("is_school", "event_")),
]


def importance_groups(columns: list[str] = FEATURES) -> dict[str, list[str]]:
    """The features of every group, in their own order."""
    groups: dict[str, list[str]] = {name: [] for name, _ in GROUP_STEMS}
    for c in columns:
        groups[next(name for name, stems in GROUP_STEMS if c.startswith(stems))].append(c)
    return groups
