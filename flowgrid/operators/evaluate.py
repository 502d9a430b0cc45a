"""Scores, folds, tests and intervals over a prediction frame.

A prediction frame has series keys, a position (``h`` or ``day``), ``y`` (actual), ``pred`` and, for backtests, ``fold``
and ``model``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.scalars import pct_error, ratio
from flowgrid.functions.timefns import day_of_hour
from flowgrid.operators.quantiles import exact_quantile, exact_quantiles
from flowgrid.operators.series import attach


def error() -> Column:
    return F.col("pred") - F.col("y")


def mape() -> Column:
    return F.avg(pct_error("pred", "y"))


def wape() -> Column:
    return ratio(F.sum(F.abs(error())), F.sum(F.abs("y"))) * 100


def bias_pct() -> Column:
    return ratio(F.sum(error()), F.sum("y")) * 100


def metrics(df: DataFrame, keys: list[str], peak_q: float = 0.9) -> DataFrame:
    """mape, wape, mae, rmse, bias_pct and the MAPE over the hours at or above the ``peak_q`` quantile of y."""
    cut = exact_quantile(df, keys, "y", peak_q, "_cut")
    peak = F.when(F.col("y") >= F.col("_cut"), F.abs(error()) / F.col("y") * 100)
    return attach(df, cut, keys).groupBy(*keys).agg(
        F.count("*").alias("n"), mape().alias("mape"), wape().alias("wape"), F.avg(F.abs(error())).alias("mae"),
        F.sqrt(F.avg(error() * error())).alias("rmse"), bias_pct().alias("bias_pct"), F.avg(peak).alias("peak_mape"))


def holdout_cutoff(df: DataFrame, days: int, pos: str = "h") -> DataFrame:
    """One row: the first hour of the last ``days`` calendar days."""
    return df.agg(((F.max(day_of_hour(pos)) - (days - 1)) * 24).alias("cutoff"))


def time_split(df: DataFrame, days: int, pos: str = "h") -> DataFrame:
    """Add ``part``: 'train' before the cutoff, 'holdout' from it on."""
    tagged = attach(df, holdout_cutoff(df, days, pos), [])
    return tagged.withColumn("part", F.when(F.col(pos) < F.col("cutoff"), "train").otherwise("holdout")).drop("cutoff")


def fold_table(df: DataFrame, n_folds: int, fold_days: int, pos: str = "h") -> DataFrame:
    """fold, test_start, test_end (hours): consecutive test windows ending with the last day of the data."""
    end = df.agg(((F.max(day_of_hour(pos)) + 1) * 24).alias("_end"))
    i = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold")
    start = F.col("_end") - (n_folds - F.col("fold")) * fold_days * 24
    return end.select("_end", i).select("fold", start.alias("test_start"), (start + fold_days * 24).alias("test_end"))


def rolling_origin(df: DataFrame, n_folds: int, fold_days: int, pos: str = "h", gap: int = 0) -> DataFrame:
    """Attach every row to the expanding train window or the test window of each fold -> fold, part.

    The windows follow from the end of the data by arithmetic, so a row is exploded only into the folds that use it;
    there is no range join.
    """
    end = df.agg(((F.max(day_of_hour(pos)) + 1) * 24).alias("_end"))
    size = fold_days * 24
    back = F.floor((F.col("_end") - 1 - F.col(pos)) / size)
    own = (F.lit(n_folds - 1) - back).cast("int")
    folds = F.sequence(F.greatest(own, F.lit(0)), F.lit(n_folds - 1))
    out = attach(df, end, []).withColumn("fold", F.explode(folds)).withColumn("_own", own)
    start = F.col("_end") - (n_folds - F.col("fold")) * size
    part = F.when(F.col("fold") == F.col("_own"), "test").when(F.col(pos) < start - gap, "train")
    return out.withColumn("part", part).where(F.col("part").isNotNull()).drop("_end", "_own")


def monthly_folds(df: DataFrame, ts: Column) -> DataFrame:
    """Calendar-month test folds."""
    return df.withColumn("fold", F.trunc(ts.cast("date"), "month"))


def refit_backtest(df: DataFrame, day: str, label: str, columns: list[str], alpha: float = 1.0, gap_days: int = 1,
                   least: int = 60) -> DataFrame:
    """``df`` (day number, label, features) with ``fold`` (first of the calendar month) and ``pred`` of a ridge that is
    fitted anew for every fold on all rows up to ``gap_days`` before it.

    Features are standardised on the training rows of the fold. A fit needs only sums of products, so the rows are added
    up once, by the first fold that may learn from them; running totals over months (one row each) are the training
    sums of every fold, and small systems are all that is solved outside the engine. Folds with fewer than ``least``
    training rows, and rows with a missing feature, get no prediction.
    """
    import numpy as np

    names = [*columns, label]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:] if a != label]
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.col(day).cast("int"))
    whole = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names]))
    first = F.add_months(F.trunc(F.date_add(date, gap_days), "month"), 1)  # the first month that starts after the gap
    sums = whole.groupBy(first.alias("fold")).agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in names], *[
        F.sum(F.col(a).cast("double") * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs])
    months = df.select(F.trunc(date, "month").alias("fold")).distinct().join(sums, "fold", "full")
    so_far = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)  # a row per month
    total = months.select("fold", *[F.sum(F.col(c).cast("double")).over(so_far).alias(c) for c in sums.columns if c != "fold"])
    out = [f"w_{c}" for c in columns]

    def solve(batches):
        for pdf in batches:
            pdf = pdf[pdf["n"] >= least].reset_index(drop=True)
            n = pdf["n"].to_numpy()[:, None]
            mean = pdf[[f"s_{c}" for c in names]].to_numpy() / n
            k = len(columns)
            cov = np.empty((len(pdf), k, k + 1))
            for a, b in pairs:
                i, j = names.index(a), names.index(b)
                cov[:, i, j] = pdf[f"p_{a}_{b}"] / n[:, 0] - mean[:, i] * mean[:, j]
                if j < k:
                    cov[:, j, i] = cov[:, i, j]
            sd = np.sqrt(np.maximum(cov[:, range(k), range(k)], 0))
            inv = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
            left = n[..., None] * cov[:, :, :k] * inv[:, :, None] * inv[:, None, :] + alpha * np.eye(k)
            beta = np.linalg.solve(left, (n * cov[:, :, k] * inv)[..., None])[..., 0] * inv
            yield pdf[["fold"]].assign(w_0=mean[:, k] - (beta * mean[:, :k]).sum(1), **{o: beta[:, i] for i, o in enumerate(out)})

    fits = total.mapInPandas(solve, "fold date, w_0 double, " + ", ".join(f"`{o}` double" for o in out))
    rows = df.withColumn("fold", F.trunc(date, "month")).join(F.broadcast(fits), "fold", "left")  # a row per month
    pred = reduce(lambda a, b: a + b, [F.col(o) * F.col(c) for o, c in zip(out, columns)], F.col("w_0"))
    return rows.withColumn("pred", pred).drop("w_0", *out)


def daily_total_ape(df: DataFrame, keys: list[str], day: Column) -> DataFrame:
    """Mean over days of |sum pred - sum y| / sum y."""
    per_day = df.groupBy(*keys, day.alias("_day")).agg(F.sum("pred").alias("p"), F.sum("y").alias("a"))
    return per_day.groupBy(*keys).agg((F.avg(ratio(F.abs(F.col("p") - F.col("a")), F.col("a"))) * 100)
                                      .alias("daily_total_ape"))


def latest_forecast(log: DataFrame, keys: list[str], pos: str = "h") -> DataFrame:
    """The scored forecast of an hour: last issued, then last written."""
    rest = [c for c in log.columns if c not in (*keys, pos)]
    order = F.struct(*[c for c in ("issued_h", "issued_at", "created_at", "created_seq") if c in rest])
    best = log.groupBy(*keys, pos).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, pos, *[F.col("_r")[c].alias(c) for c in rest])


def reconcile(log: DataFrame, actuals: DataFrame, keys: list[str], pos: str = "h") -> DataFrame:
    """Every forecast hour with its actual: error and absolute % error. All owed days in one pass."""
    best = latest_forecast(log, keys, pos)
    both = best.join(actuals.select(*keys, pos, F.col("demand").alias("actual_m3")), [*keys, pos])
    return (both.withColumn("forecast_day", day_of_hour(pos))
            .withColumn("error_m3", F.col("predicted_m3") - F.col("actual_m3"))
            .withColumn("abs_pct_error", pct_error("predicted_m3", "actual_m3")))


def daily_accuracy(hourly: DataFrame, keys: list[str], day: str = "forecast_day") -> DataFrame:
    err, act = F.col("error_m3"), F.sum("actual_m3")
    return hourly.groupBy(*keys, day).agg(
        F.count("*").alias("hours_scored"), F.avg("abs_pct_error").alias("mape"),
        (ratio(F.sum(F.abs(err)), act) * 100).alias("wape"), (ratio(F.sum(err), act) * 100).alias("bias_pct"),
        F.max("abs_pct_error").alias("max_abs_pct_error"))


def backlog_range(history: DataFrame, log: DataFrame, scored: DataFrame | None, pos: str = "h") -> DataFrame:
    """One row: first and last day to score. Yesterday is always scored again."""
    last = history.agg(F.max(day_of_hour(pos)).alias("last_day"))
    if scored is not None:
        start = scored.agg((F.max("forecast_day") + 1).alias("_from"))
    else:
        start = log.agg(F.min(day_of_hour(pos)).alias("_from"))
    both = last.unionByName(start, allowMissingColumns=True).agg(
        F.max("last_day").alias("last_day"), F.max("_from").alias("_from"))
    return both.select(F.least("last_day", F.coalesce("_from", "last_day")).alias("first_day"), "last_day")


def daily_losses(df: DataFrame, keys: list[str], day: Column) -> DataFrame:
    return df.groupBy(*keys, day.alias("day")).agg(mape().alias("loss"))


def diebold_mariano(losses: DataFrame, keys: list[str], a: str = "loss_a", b: str = "loss_b",
                    lags: int = 7, day: str = "day") -> DataFrame:
    """Difference of two daily losses with a Newey-West (Bartlett) variance -> keys, n, mean_diff, dm_stat.

    One row per day and pair, so the ordered window is bounded by the calendar.
    """
    d = losses.select(*keys, day, (F.col(a) - F.col(b)).alias("d")).where(F.col("d").isNotNull())
    centre = d.groupBy(*keys).agg(F.avg("d").alias("mean_diff"), F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy(day)
    dev = attach(d, centre, keys).withColumn("c", F.col("d") - F.col("mean_diff"))
    prods = dev.select(*keys, "n", "mean_diff", (F.col("c") * F.col("c")).alias("v0"), *[
        (F.col("c") * F.lag("c", k).over(order)).alias(f"v{k}") for k in range(1, lags + 1)])
    sums = prods.groupBy(*keys).agg(F.first("n").alias("n"), F.first("mean_diff").alias("mean_diff"),
                                    *[F.sum(f"v{k}").alias(f"v{k}") for k in range(lags + 1)])
    var = F.col("v0") / F.col("n")
    for k in range(1, lags + 1):
        var = var + 2 * (1 - k / (lags + 1)) * F.coalesce(F.col(f"v{k}"), F.lit(0.0)) / F.col("n")
    stat = F.when(var > 0, F.col("mean_diff") / F.sqrt(var / F.col("n")))
    return sums.select(*keys, "n", "mean_diff", stat.alias("dm_stat"))


# Chebyshev fit of ln(erfc(x) exp(x^2) / t) in t = 1 / (1 + x / 2), relative error below 1.2e-7.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def two_sided_p(z: str) -> Column:
    """2 (1 - Phi(|z|)) = erfc(|z| / sqrt 2) as column arithmetic."""
    x = F.abs(F.col(z)) / F.lit(2.0 ** 0.5)
    t = 1 / (1 + x / 2)
    fit = F.lit(ERFC[-1])
    for c in ERFC[-2::-1]:
        fit = fit * t + F.lit(c)
    return t * F.exp(fit - x * x)


def fold_stability(df: DataFrame) -> DataFrame:
    """Per model: mean, std and worst fold MAPE, and in how many folds it is best."""
    per = df.groupBy("model", "fold").agg(mape().alias("fold_mape"))
    best = per.groupBy("fold").agg(F.min_by("model", F.struct("fold_mape", "model")).alias("model"))
    wins = best.groupBy("model").agg(F.count("*").alias("folds_best"))
    agg = per.groupBy("model").agg(F.avg("fold_mape").alias("mean_mape"), F.stddev_samp("fold_mape").alias("std_mape"),
                                   F.max("fold_mape").alias("worst_mape"))
    return agg.join(wins, "model", "left").withColumn("folds_best", F.coalesce("folds_best", F.lit(0)))


def ladder(scores: DataFrame, order: str, value: str = "mape") -> DataFrame:
    """Step-wise gains: value of the previous step minus this one (a handful of rows)."""
    w = Window.orderBy(order)
    return scores.withColumn("gain", F.lag(value).over(w) - F.col(value))


def leaderboard(scores: DataFrame, production: str) -> DataFrame:
    """Rank by MAPE and % change against the production model (one row per model)."""
    ref = scores.where(F.col("model") == production).select(F.col("mape").alias("_ref"))
    rank = F.row_number().over(Window.orderBy("mape", "model"))
    return attach(scores, ref, []).select(
        *scores.columns, rank.alias("rank"), ((F.col("mape") / F.col("_ref") - 1) * 100).alias("vs_production_pct"))


def pivot_models(df: DataFrame, keys: list[str], models: list[str]) -> DataFrame:
    """Align several models by key in one shuffle instead of n joins."""
    return df.groupBy(*keys).agg(F.max("y").alias("y"), *[
        F.max(F.when(F.col("model") == m, F.col("pred"))).alias(m) for m in models])


def ensemble(df: DataFrame, keys: list[str], members: list[str]) -> DataFrame:
    """Equal-weight mean of the members where all of them predicted."""
    part = df.where(F.col("model").isin(members)).groupBy(*keys).agg(
        F.max("y").alias("y"), F.avg("pred").alias("pred"), F.count("pred").alias("_n"))
    return part.where(F.col("_n") == len(members)).drop("_n")


def past_sums(df: DataFrame, keys: list[str], sums: dict[str, Column], fold: str = "fold") -> DataFrame:
    """Sums over the rows of all earlier folds -> keys, for_fold and a column for each entry of ``sums`` (any additive
    aggregate). Rows are added up once, in their own fold; running totals over folds, a row each, do the rest. A fold
    with none before it has no row."""
    own = df.groupBy(*keys, fold).agg(*[c.alias(n) for n, c in sums.items()])
    past = Window.partitionBy(*keys).orderBy(fold).rowsBetween(Window.unboundedPreceding, -1)
    totals = own.select(*keys, F.col(fold).alias("for_fold"), F.count(F.lit(1)).over(past).alias("_folds"),
                        *[F.sum(n).over(past).alias(n) for n in sums])
    return totals.where("_folds > 0").drop("_folds")


def conformal(df: DataFrame, keys: list[str], level: float = 0.8, fold: str = "fold") -> DataFrame:
    """Widen lo/hi by the ``level`` quantile of the scores of all earlier folds -> lo_cal, hi_cal (first fold null)."""
    miss = F.greatest(F.col("lo") - F.col("y"), F.col("y") - F.col("hi")) / F.col("pred")
    scored = df.withColumn("score", miss)
    out = scored.join(exact_quantile(scored, keys, "score", level, "q", fold), [*keys, fold], "left")
    return (out.withColumn("lo_cal", F.col("lo") - F.col("q") * F.col("pred"))
            .withColumn("hi_cal", F.col("hi") + F.col("q") * F.col("pred")))


def coverage(df: DataFrame, keys: list[str], lo: str, hi: str) -> DataFrame:
    """Share of actuals inside and mean half width, both in %."""
    inside = F.col("y").between(F.col(lo), F.col(hi)).cast("double")
    return df.groupBy(*keys).agg((F.avg(inside) * 100).alias("coverage_pct"),
                                 (F.avg((F.col(hi) - F.col(lo)) / F.col("pred")) * 50).alias("half_width_pct"))


def ratio_band(df: DataFrame, group: list[str], fold: str = "fold", lo_q: float = 0.1,
               hi_q: float = 0.9) -> DataFrame:
    """Band = forecast x empirical quantiles of y / pred per group over the earlier folds -> lo, hi."""
    rated = F.when(F.col("pred") > 0, F.col("y") / F.col("pred"))
    band = exact_quantiles(df.select(*group, fold, rated.alias("_r")), group, "_r", {"_lo": lo_q, "_hi": hi_q}, fold)
    return (df.join(band, [*group, fold], "left").withColumn("lo", F.col("pred") * F.col("_lo"))
            .withColumn("hi", F.col("pred") * F.col("_hi")).drop("_lo", "_hi"))


def segments(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("hours"), mape().alias("mape"), bias_pct().alias("bias_pct"))
