"""Evaluation, monitoring and decisions (inventory L) on seasonal-naive predictions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from flowgrid.config import Decisions
from flowgrid.functions.timefns import day_date, day_of_hour, hour_of_day, hour_ts
from flowgrid.operators import backtest as B
from flowgrid.operators import decide as D
from flowgrid.operators import evaluate as E
from flowgrid.operators import explore as X
from flowgrid.operators import features as FE
from flowgrid.operators import quantreg as QR
from flowgrid.operators import series
from flowgrid.operators.models import INTERACTION_ALPHA, linear_columns, seasonal_naive
from flowgrid.operators.quantiles import exact_quantile
from flowgrid.plans import dashboard
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.queries.features import built
from flowgrid.queries.tables import EID_TYPE
from flowgrid.session import shared_folder
from flowgrid.sources import inputs as I
from flowgrid.sources import tables as T

METRIC_SQL = f"""{R('avg(CASE WHEN y > 0 THEN abs(pred - y) / y * 100 END)')} AS mape,
  {R('sum(abs(pred - y)) / nullif(sum(abs(y)), 0) * 100')} AS wape, {R('avg(abs(pred - y))', 4)} AS mae,
  {R('sqrt(avg((pred - y) * (pred - y)))', 4)} AS rmse, {R('sum(pred - y) / nullif(sum(y), 0) * 100')} AS bias_pct,
  {R('avg(CASE WHEN y >= cut THEN abs(pred - y) / y * 100 END)')} AS peak_mape"""


def _metrics_out(df):
    a = out(df.drop("mae", "rmse"))
    keys = [c for c in df.columns if c in ("series", "model")]
    return a.join(out(df.select(*keys, "mae", "rmse"), 4), keys)


@query("metrics", f"""
SELECT series, model, count(*) AS n, {METRIC_SQL} FROM (
  SELECT p.*, c.cut FROM v_pred p JOIN (SELECT series, model, quantile_cont(y, 0.9) AS cut FROM v_pred GROUP BY ALL) c
    ON c.series = p.series AND c.model = p.model) GROUP BY ALL""")
def metrics(spark, sf):
    return _metrics_out(E.metrics(I.predictions(spark, sf), ["series", "model"]))


@query("time_split", f"""
SELECT series, {TS('h')} AS ts, CASE WHEN h < (SELECT (max(h // 24) - 6) * 24 FROM v_demand) THEN 'train' ELSE 'holdout' END AS part
FROM v_demand""")
def time_split(spark, sf):
    return out(E.time_split(I.demand(spark, sf), 7).select("series", "h", "part"))


@query("rolling_origin", f"""
WITH e AS (SELECT (max(h // 24) + 1) * 24 AS hi FROM v_demand),
f AS (SELECT fold, hi - (4 - fold) * 120 AS a, hi - (4 - fold) * 120 + 120 AS b FROM e, (SELECT unnest([0, 1, 2, 3]) AS fold))
SELECT series, CAST(fold AS INTEGER) AS fold, count(*) FILTER (h < a) AS train, count(*) FILTER (h >= a) AS test,
  {TS('max(h) FILTER (h < a)')} AS train_end, {TS('min(h) FILTER (h >= a)')} AS test_start FROM v_demand, f WHERE h < b GROUP BY ALL""")
def rolling_origin(spark, sf):
    f = E.rolling_origin(I.demand(spark, sf), 4, 5)
    train, test = F.when(F.col("part") == "train", F.col("h")), F.when(F.col("part") == "test", F.col("h"))
    g = f.groupBy("series", "fold").agg(F.count(train).alias("train"), F.count(test).alias("test"),
                                        F.max(train).alias("a"), F.min(test).alias("b"))
    return g.select("series", "fold", "train", "test", hour_ts("a").alias("train_end"), hour_ts("b").alias("test_start"))


@query("monthly_backtest", f"""
SELECT fold, model, count(*) AS n, {R('avg(abs(pred - y) / y) * 100')} AS mape, {R('sum(pred - y) / sum(y) * 100')} AS bias_pct
FROM v_lpred GROUP BY ALL""")
def monthly_backtest(spark, sf):
    return out(I.long_predictions(spark, sf).groupBy("fold", "model").agg(
        F.count("*").alias("n"), E.mape().alias("mape"), E.bias_pct().alias("bias_pct")))


@query("refit_backtest", f"""
WITH w AS MATERIALIZED (SELECT day, y, fold, max(pred) FILTER (model = 'naive_7') AS a, max(pred) FILTER (model = 'mean_3w') AS b
  FROM v_lpred GROUP BY ALL),
f AS (SELECT DISTINCT fold FROM w),
t AS (SELECT f.fold, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
  covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM f JOIN w ON {DT('w.day')} < f.fold - 1
  WHERE a IS NOT NULL AND b IS NOT NULL AND y IS NOT NULL GROUP BY f.fold HAVING count(*) >= 60),
r AS (SELECT *, n * ab / (sa * sb) AS o, n * ay / sa AS ra, n * by_ / sb AS rb, (n + 1.0) * (n + 1.0) - (n * ab / (sa * sb)) ** 2 AS det FROM t),
c AS (SELECT *, (ra * (n + 1.0) - o * rb) / det / sa AS wa, (rb * (n + 1.0) - o * ra) / det / sb AS wb FROM r),
p AS (SELECT w.fold, 'ridge' AS model, y, my - wa * ma - wb * mb + wa * a + wb * b AS pred FROM w JOIN c ON c.fold = w.fold
  UNION ALL SELECT w.fold, 'naive', y, a FROM w JOIN c ON c.fold = w.fold)
SELECT fold, model, count(pred) AS n, {R('avg(CASE WHEN y > 0 THEN abs(pred - y) / y END) * 100', 4)} AS mape,
  {R('sum(pred - y) / sum(CASE WHEN pred IS NOT NULL THEN y END) * 100', 4)} AS bias_pct FROM p GROUP BY ALL""")
def refit_backtest(spark, sf):
    """Monthly folds, the ridge fitted anew for each one, next to the naive forecast on the same days."""
    wide = I.long_predictions(spark, sf).groupBy("day", "y").pivot("model", ["naive_7", "mean_3w"]).agg(F.max("pred"))
    fitted = E.refit_backtest(wide, "day", "y", ["naive_7", "mean_3w"])
    long = fitted.where(F.col("pred").isNotNull()).select("fold", "y", F.explode(F.array(
        F.struct(F.lit("ridge").alias("model"), "pred"), F.struct(F.lit("naive").alias("model"), F.col("naive_7").alias("pred")))).alias("m"))
    return out(long.select("fold", "y", "m.*").groupBy("fold", "model").agg(
        F.count("pred").alias("n"), E.mape().alias("mape"), E.bias_pct().alias("bias_pct")), 4)


@query("interaction_backtest")
def interaction_backtest(spark, sf):
    """Twelve folds of two days, the interaction ridge of the hourly features fitted anew for each; a fold learns from all
    labelled hours up to a day before it. Scores next to the seasonal naive forecast on the same hours."""
    path = f"{shared_folder(spark, 'features')}/hourly"
    rows = FE.attach_label(built(spark, sf), I.demand(spark, sf), ["series"]).withColumnRenamed("demand", "y")
    T.overwrite(rows, path)
    rows = spark.read.schema(rows.schema).parquet(path)
    folds, size = 12, 48
    rows = series.attach(rows, rows.agg(((F.max(day_of_hour("h")) + 1) * 24 - folds * size).alias("_start")), [])
    at = F.floor((F.col("h") - F.col("_start")) / size)
    first = F.greatest(F.lit(0), F.floor((F.col("h") - F.col("_start") + 24) / size) + 1)
    scored = B.interaction_backtest(rows, at, first, folds, linear_columns(FE.FEATURES), ["is_day_off", "is_ramadan", "fc_cdd24_hour"],
                                    alpha=INTERACTION_ALPHA)
    naive = F.avg(F.when(F.col("y") > 0, F.abs(F.col("lag_168h") - F.col("y")) / F.col("y"))) * 100
    return out(scored.groupBy("fold").agg(F.max("n_train").alias("n_train"), F.count("pred").alias("n"), E.mape().alias("mape"),
                                          E.bias_pct().alias("bias_pct"), naive.alias("naive_mape")), 4)


@query("daily_total_ape", f"""
SELECT series, model, {R('avg(abs(p - a) / nullif(a, 0)) * 100')} AS daily_total_ape FROM (
  SELECT series, model, h // 24 AS day, sum(pred) AS p, sum(y) AS a FROM v_pred GROUP BY ALL) GROUP BY ALL""")
def daily_total_ape(spark, sf):
    return out(E.daily_total_ape(I.predictions(spark, sf), ["series", "model"], day_of_hour("h")))


REC = f"""series, {DT('forecast_day')} AS forecast_date, {TS('h')} AS ts, {TS('issued_h')} AS issued_at, model_version, predicted_m3,
  actual_m3, {R('error_m3')} AS error_m3, {R('abs_pct_error')} AS abs_pct_error"""


def hourly(spark, sf):
    return E.reconcile(I.forecast_log(spark, sf), I.demand(spark, sf), ["series"])


@query("reconcile", f"SELECT {REC} FROM v_rec")
def reconcile(spark, sf):
    return out(hourly(spark, sf).select("series", day_date("forecast_day").alias("forecast_date"), "h",
                                        hour_ts("issued_h").alias("issued_at"), "model_version", "predicted_m3", "actual_m3",
                                        "error_m3", "abs_pct_error"))


ACC = f"""series, {DT('forecast_day')} AS date, hours_scored, {R('mape')} AS mape, {R('wape')} AS wape, {R('bias_pct')} AS bias_pct,
  {R('max_abs_pct_error')} AS max_abs_pct_error"""


def accuracy(spark, sf):
    return E.daily_accuracy(hourly(spark, sf), ["series"])


@query("daily_accuracy", f"SELECT {ACC} FROM v_acc")
def daily_accuracy(spark, sf):
    return out(accuracy(spark, sf).withColumnRenamed("forecast_day", "day"))


@query("run_naive_daily", f"""
SELECT {DT('h // 24')} AS date, count(*) AS hours, {R('avg(abs(pred - y) / y) * 100')} AS mape FROM (
  SELECT t.h, t.demand AS y, coalesce(a.demand, (a.demand + b.demand + c.demand) / 3) AS pred FROM v_total t
  LEFT JOIN v_total a ON a.h = t.h - 168 LEFT JOIN v_total b ON b.h = t.h - 336 LEFT JOIN v_total c ON c.h = t.h - 504)
WHERE pred IS NOT NULL AND y > 0 GROUP BY ALL""")
def run_naive_daily(spark, sf):
    d = I.demand_total(spark, sf)
    j = series.lag_join(d.withColumnRenamed("demand", "y"), d, [], "h", "demand",
                        {"lag_168h": 168, "lag_336h": 336, "lag_504h": 504})
    mean = (F.col("lag_168h") + F.col("lag_336h") + F.col("lag_504h")) / 3
    p = j.withColumn("same_hour_mean_3w", mean).withColumn("pred", seasonal_naive())
    scored = p.where(F.col("pred").isNotNull() & (F.col("y") > 0))
    return out(scored.groupBy(day_of_hour("h").alias("day")).agg(F.count("*").alias("hours"), E.mape().alias("mape")))


@query("reconcile_backlog", f"""
WITH l AS (SELECT max(h // 24) AS last_day FROM v_demand),
r AS (SELECT 'resume' AS mode, least(last_day, (SELECT max(forecast_day) + 1 FROM v_acc WHERE forecast_day <= last_day - 4)) AS first_day,
    last_day FROM l
  UNION ALL SELECT 'first', least(last_day, (SELECT min(h // 24) FROM v_log)), last_day FROM l)
SELECT r.mode, {DT('a.forecast_day')} AS date, a.series, a.hours_scored, {R('a.mape')} AS mape FROM r JOIN v_acc a
  ON a.forecast_day BETWEEN r.first_day AND r.last_day""")
def reconcile_backlog(spark, sf):
    d, log, acc = I.demand(spark, sf), I.forecast_log(spark, sf), accuracy(spark, sf)
    old = series.attach(acc, d.agg((F.max(day_of_hour("h")) - 4).alias("_until")), [])
    res = None
    for mode, scored in (("resume", old.where(F.col("forecast_day") <= F.col("_until"))), ("first", None)):
        owed = E.backlog_range(d, log, scored)
        todo = series.attach(log, owed, []).where(day_of_hour("h").between(F.col("first_day"), F.col("last_day")))
        done = E.daily_accuracy(E.reconcile(todo.drop("first_day", "last_day"), d, ["series"]), ["series"])
        one = done.select(F.lit(mode).alias("mode"), F.col("forecast_day").alias("day"), "series", "hours_scored", "mape")
        res = one if res is None else res.unionByName(one)
    return out(res)


@query("fair_window", """
SELECT model, count(*) FILTER (u) AS hours, count(DISTINCT CASE WHEN u THEN h // 24 END) AS days,
  count(DISTINCT CASE WHEN u THEN h // 24 END) >= 7 OR bool_or(through IS NULL) AS comparable FROM (
    SELECT *, through IS NULL OR h > through AS u FROM (
      SELECT p.*, CASE model WHEN 'naive_48' THEN hi - 2 * 24 WHEN 'naive_168' THEN hi - 8 * 24 END AS through
      FROM v_pred p, (SELECT max(h) AS hi FROM v_demand))) GROUP BY model""")
def fair_window(spark, sf):
    p = I.predictions(spark, sf)
    hi = I.demand(spark, sf).agg(F.max("h").alias("hi"))
    m = F.col("model")
    through = F.when(m == "naive_48", F.col("hi") - 48).when(m == "naive_168", F.col("hi") - 192)
    return D.fair_hours(series.attach(p, hi, []), through, ["model"])


@query("should_promote", f"""
WITH s AS (SELECT series, avg(abs(pred - y) / y) FILTER (model = 'mean_3w') * 100 AS challenger,
  avg(abs(pred - y) / y) FILTER (model = 'naive_168') * 100 AS champion FROM v_pred GROUP BY series)
SELECT series, {R('challenger')} AS challenger, {R('champion')} AS champion,
  CASE WHEN challenger > 100000 THEN false WHEN champion IS NULL THEN true ELSE (champion - challenger) / champion * 100 >= 1 END AS promote
FROM s""")
def should_promote(spark, sf):
    p = I.predictions(spark, sf)
    s = p.groupBy("series").agg(*[
        (F.avg(F.when(F.col("model") == m, F.abs(E.error()) / F.col("y"))) * 100).alias(n)
        for m, n in (("mean_3w", "challenger"), ("naive_168", "champion"))])
    rule = Decisions(max_acceptable_mape=100000.0)
    return out(s.withColumn("promote", D.promote_column(F.col("challenger"), F.col("champion"), rule)))


@query("needs_retrain", """
WITH b AS (SELECT series, median(mape) AS base FROM v_acc GROUP BY series),
l AS (SELECT * FROM v_acc QUALIFY row_number() OVER (PARTITION BY series ORDER BY forecast_day DESC) <= 3)
SELECT l.series, count(*) AS days, bool_and(l.mape > b.base * 1.25) AS all_worse,
  count(*) >= 3 AND bool_and(l.mape > b.base * 1.25) AS retrain FROM l JOIN b ON b.series = l.series GROUP BY ALL""")
def needs_retrain(spark, sf):
    acc = accuracy(spark, sf)
    base = acc.groupBy("series").agg(F.median("mape").alias("base"))
    return D.needs_retrain(acc.join(base, "series"), ["series"], F.col("base"))


@query("fold_stability", f"""
WITH p AS (SELECT model, fold, avg(abs(pred - y) / y) * 100 AS m FROM v_lpred GROUP BY ALL),
b AS (SELECT model, count(*) AS n FROM (SELECT fold, arg_min(model, m) AS model FROM p GROUP BY fold) GROUP BY model)
SELECT p.model, {R('avg(m)')} AS mean_mape, {R('stddev_samp(m)')} AS std_mape, {R('max(m)')} AS worst_mape,
  coalesce(any_value(b.n), 0) AS folds_best FROM p LEFT JOIN b ON b.model = p.model GROUP BY p.model""")
def fold_stability(spark, sf):
    return out(E.fold_stability(I.long_predictions(spark, sf)))


PAIRS = [("naive_48", "naive_168"), ("naive_168", "mean_3w"), ("naive_48", "mean_3w")]


def _losses(spark, sf):
    p = I.predictions(spark, sf)
    loss = E.daily_losses(p, ["series", "model"], day_of_hour("h"))
    wide = loss.groupBy("series", "day").agg(*[F.max(F.when(F.col("model") == m, F.col("loss"))).alias(m) for m in I.MODELS])
    pairs = ", ".join(f"'{a} - {b}', {a}, {b}" for a, b in PAIRS)
    return wide.selectExpr("series", "day", f"stack({len(PAIRS)}, {pairs}) as (pair, loss_a, loss_b)")


DM = """
WITH l AS (SELECT series, model, h // 24 AS day, avg(abs(pred - y) / y) * 100 AS loss FROM v_pred GROUP BY ALL),
d AS (SELECT a.series, a.model || ' - ' || b.model AS pair, a.day, a.loss - b.loss AS d FROM l a JOIN l b
  ON a.series = b.series AND a.day = b.day
  AND (a.model, b.model) IN (('naive_48', 'naive_168'), ('naive_168', 'mean_3w'), ('naive_48', 'mean_3w'))),
c AS (SELECT *, d - avg(d) OVER (PARTITION BY series, pair) AS c, count(*) OVER (PARTITION BY series, pair) AS n,
  avg(d) OVER (PARTITION BY series, pair) AS m, row_number() OVER (PARTITION BY series, pair ORDER BY day) AS i FROM d),
v AS (SELECT a.series, a.pair, a.n, a.m, sum(CASE WHEN a.i = b.i THEN a.c * b.c / a.n
    ELSE 2 * (1 - (a.i - b.i) / 8.0) * a.c * b.c / a.n END) AS var
  FROM c a JOIN c b ON a.series = b.series AND a.pair = b.pair AND a.i - b.i BETWEEN 0 AND 7 GROUP BY ALL)"""
HORNER = "".join(f"{c} + t * (" for c in E.ERFC[:-1]) + str(E.ERFC[-1]) + ")" * (len(E.ERFC) - 1)


@query("diebold_mariano", f"""{DM}
SELECT series, pair, n, {R('m', 4)} AS mean_diff, {R('CASE WHEN var > 0 THEN m / sqrt(var / n) END', 4)} AS dm_stat FROM v""")
def diebold_mariano(spark, sf):
    return out(E.diebold_mariano(_losses(spark, sf), ["series", "pair"]), 4)


@query("diebold_mariano_p", f"""
{DM}, x AS (SELECT series, pair, abs(CASE WHEN var > 0 THEN m / sqrt(var / n) END) / sqrt(2.0) AS x FROM v),
tx AS (SELECT *, 1 / (1 + x / 2) AS t FROM x)
SELECT series, pair, {R('t * exp(' + HORNER + ' - x * x)', 4)} AS p_value FROM tx""")
def diebold_mariano_p(spark, sf):
    dm = E.diebold_mariano(_losses(spark, sf), ["series", "pair"])
    return out(dm.select("series", "pair", E.two_sided_p("dm_stat").alias("p_value")), 4)


@query("ablation_ladder", f"""
WITH s AS (SELECT CASE model WHEN 'naive_7' THEN 1 WHEN 'mean_3w' THEN 2 ELSE 3 END AS step, model,
  avg(abs(pred - y) / y) * 100 AS m FROM v_lpred GROUP BY ALL)
SELECT CAST(step AS INTEGER) AS step, model, {R('m')} AS mape, {R('lag(m) OVER (ORDER BY step) - m')} AS gain FROM s""")
def ablation_ladder(spark, sf):
    m = F.col("model")
    step = F.when(m == "naive_7", 1).when(m == "mean_3w", 2).otherwise(3).alias("step")
    s = I.long_predictions(spark, sf).groupBy(step, "model").agg(E.mape().alias("mape"))
    return out(E.ladder(s, "step"))


@query("segment_errors", f"""
SELECT p.model, {EID_TYPE.replace('is_', 'c.is_')} AS day_type, CAST(p.h % 24 AS INTEGER) AS hour, count(*) AS hours,
  {R('avg(CASE WHEN y > 0 THEN abs(pred - y) / y * 100 END)')} AS mape, {R('sum(pred - y) / nullif(sum(y), 0) * 100')} AS bias_pct
FROM v_pred p JOIN v_cal c ON c.day = p.h // 24 GROUP BY ALL""")
def segment_errors(spark, sf):
    cal = I.calendar(spark, sf).select("day", X.day_type(True).alias("day_type"))
    p = I.predictions(spark, sf).withColumn("day", day_of_hour("h")).withColumn("hour", hour_of_day("h"))
    return out(E.segments(p.join(F.broadcast(cal), "day"), ["model", "day_type", "hour"]))


@query("segment_months", f"""
SELECT model, CAST(month(fold) AS INTEGER) AS month, count(*) AS hours, {R('avg(abs(pred - y) / y) * 100')} AS mape,
  {R('sum(pred - y) / sum(y) * 100')} AS bias_pct, count(*) FILTER (y >= cut) AS peak_days FROM v_lpred,
  (SELECT quantile_cont(y, 0.9) AS cut FROM v_lwide) GROUP BY ALL""")
def segment_months(spark, sf):
    cut = exact_quantile(I.wide_long(spark, sf), [], "y", 0.9, "cut")
    p = series.attach(I.long_predictions(spark, sf), cut, []).withColumn("month", F.month("fold"))
    return out(p.groupBy("model", "month").agg(
        F.count("*").alias("hours"), E.mape().alias("mape"), E.bias_pct().alias("bias_pct"),
        F.count(F.when(F.col("y") >= F.col("cut"), 1)).alias("peak_days")))


def _acf_sql(view: str, value: str, keys: str, lags: int) -> str:
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(",")) if keys else "true"
    part = f"PARTITION BY {keys}" if keys else ""
    sel = f"a.{keys.replace(', ', ', a.')}, " if keys else ""
    return f"""WITH c AS (SELECT {keys + ',' if keys else ''} pos, x - avg(x) OVER ({part}) AS c FROM
        (SELECT {keys + ',' if keys else ''} {value} AS x, pos FROM {view} WHERE {value} IS NOT NULL)),
      k AS (SELECT {sel} CAST(b.pos - a.pos AS INTEGER) AS lag, sum(a.c * b.c) AS s FROM c a JOIN c b
        ON {on} AND b.pos BETWEEN a.pos AND a.pos + {lags} GROUP BY ALL)
      SELECT {'k.' + keys.replace(', ', ', k.') + ', ' if keys else ''} k.lag, {R('k.s / z.s')} AS r FROM k JOIN k z ON z.lag = 0 AND
        {on.replace('a.', 'k.').replace('b.', 'z.')}"""


@query("error_acf", _acf_sql("(SELECT series, model, h AS pos, pred - y AS e FROM v_pred)", "e", "series, model", 72))
def error_acf(spark, sf):
    p = I.predictions(spark, sf).withColumn("e", E.error())
    return out(series.acf(p, ["series", "model"], "h", "e", 72))


@query("volume_error", f"""
WITH d AS (SELECT model, day, (pred - y) / y * 100 AS e FROM v_lpred)
SELECT model, {DT('day')} AS date, {R('e')} AS err_pct, {R('''CASE WHEN count(e) OVER w >= 28 THEN avg(e) OVER w END''')} AS err_28d FROM d
WINDOW w AS (PARTITION BY model ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING)""")
def volume_error(spark, sf):
    d = I.long_predictions(spark, sf).select("model", "day", (E.error() / F.col("y") * 100).alias("err_pct"))
    return out(series.centred_mean(d, ["model"], "day", "err_pct", 28, None, "err_28d"))


@query("ensemble", f"""
SELECT series, count(*) AS n, {METRIC_SQL} FROM (
  SELECT w.series, w.h, w.y, (naive_48 + naive_168 + mean_3w) / 3 AS pred, c.cut FROM v_wide w
  JOIN (SELECT series, quantile_cont(y, 0.9) AS cut FROM v_wide GROUP BY series) c ON c.series = w.series) GROUP BY series""")
def ensemble(spark, sf):
    e = E.ensemble(I.predictions(spark, sf), ["series", "h"], I.MODELS)
    return _metrics_out(E.metrics(e, ["series"]))


CONF = """f AS (SELECT day, y, model, pred, pred * 0.9 AS lo, pred * 1.1 AS hi, fold FROM v_lpred),
s AS (SELECT *, greatest(lo - y, y - hi) / pred AS score FROM f),
q AS (SELECT a.fold, b.model, quantile_cont(b.score, 0.8) AS q FROM (SELECT DISTINCT fold FROM s) a JOIN s b ON b.fold < a.fold GROUP BY ALL),
iv AS (SELECT s.*, q.q, lo - q.q * pred AS lo_cal, hi + q.q * pred AS hi_cal FROM s LEFT JOIN q ON q.fold = s.fold AND q.model = s.model)"""


def calibrated(spark, sf):
    """A fixed +-10 % band around each model's forecast, widened fold by fold."""
    p = I.long_predictions(spark, sf)
    return E.conformal(p.withColumn("lo", F.col("pred") * 0.9).withColumn("hi", F.col("pred") * 1.1), ["model"])


@query("conformal_interval", f"""
WITH {CONF} SELECT model, {DT('day')} AS date, fold, {R('q * 1000', 3)} AS q_permille, {R('lo_cal', 3)} AS lo_cal, {R('hi_cal', 3)} AS hi_cal FROM iv""")
def conformal_interval(spark, sf):
    return out(calibrated(spark, sf).select("model", "day", "fold", (F.col("q") * 1000).alias("q_permille"), "lo_cal", "hi_cal"), 3)


@query("interval_coverage", f"""
WITH {CONF} SELECT model, fold, {R('avg(CAST(y BETWEEN lo AND hi AS INTEGER)) * 100')} AS raw_coverage,
  {R('avg(CAST(y BETWEEN lo_cal AND hi_cal AS INTEGER)) * 100')} AS cal_coverage,
  {R('avg((hi_cal - lo_cal) / pred) * 50')} AS cal_half_width FROM iv WHERE q IS NOT NULL GROUP BY model, fold""")
def interval_coverage(spark, sf):
    iv = calibrated(spark, sf).where(F.col("q").isNotNull())
    inside = lambda lo, hi: F.avg(F.col("y").between(F.col(lo), F.col(hi)).cast("double")) * 100
    return out(iv.groupBy("model", "fold").agg(
        inside("lo", "hi").alias("raw_coverage"), inside("lo_cal", "hi_cal").alias("cal_coverage"),
        (F.avg((F.col("hi_cal") - F.col("lo_cal")) / F.col("pred")) * 50).alias("cal_half_width")))


@query("quantile_band", f"""
WITH p AS (SELECT series, model, h, y, pred, fold, CAST(h % 24 AS INTEGER) AS hour FROM v_pred),
q AS (SELECT a.model, a.hour, a.fold, quantile_cont(b.y / b.pred, 0.1) AS lo, quantile_cont(b.y / b.pred, 0.9) AS hi
  FROM (SELECT DISTINCT model, hour, fold FROM p) a JOIN p b ON b.model = a.model AND b.hour = a.hour AND b.fold < a.fold
  WHERE b.pred > 0 GROUP BY ALL)
SELECT p.series, p.model, {TS('p.h')} AS ts, {R('p.pred * q.lo')} AS lo, {R('p.pred * q.hi')} AS hi FROM p
LEFT JOIN q ON q.model = p.model AND q.hour = p.hour AND q.fold = p.fold""")
def quantile_band(spark, sf):
    p = I.predictions(spark, sf).withColumn("hour", hour_of_day("h"))
    return out(E.ratio_band(p, ["model", "hour"]).select("series", "model", "h", "lo", "hi"))


@query("quantile_regression_band", """
WITH c AS (SELECT min(day) + (max(day) - min(day)) * 2 // 3 AS cut FROM v_lpred)
SELECT model, count(*) FILTER (day < cut) AS n_train, count(*) FILTER (day >= cut) AS n_held_out, true AS levels_met, true AS held_out_met,
  true AS calibrated_met FROM v_lpred, c GROUP BY model""")
def quantile_regression_band(spark, sf):
    """Bands between the fitted 10 % and 90 % quantiles given the forecast and the season, learnt on the first two thirds of
    the days, for every model; then widened month by month by the misses of earlier months. Met: the shares of training
    rows below each quantile are within one point of its level, the coverage of held-out days within two of 80 %, and with
    the widening at least 78 %."""
    w = F.col("day") * F.lit(2 * math.pi / 365.25)
    p = I.long_predictions(spark, sf).withColumns({"season_s": F.sin(w), "season_c": F.cos(w)})
    ends = p.agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    p = series.attach(p, ends, []).withColumn("held_out", F.col("day") >= F.floor(F.col("_a") + (F.col("_b") - F.col("_a")) * 2 / 3)).drop("_a", "_b")
    columns = ["pred", "season_s", "season_c"]
    fit = QR.quantile_regression(p.where(~F.col("held_out")), ["model"], columns, "y", [0.1, 0.9])
    band = E.conformal(QR.banded_by(p, fit, ["model"], columns, ["lo", "hi"]), ["model"])
    share = lambda cond, where: F.avg(F.when(where, cond.cast("double"))) * 100
    held, inside = F.col("held_out"), F.col("y").between(F.col("lo"), F.col("hi"))
    s = band.groupBy("model").agg(
        F.count(F.when(~held, 1)).alias("n_train"), F.count(F.when(held, 1)).alias("n_held_out"), share(F.col("y") < F.col("lo"), ~held).alias("_lo"),
        share(F.col("y") < F.col("hi"), ~held).alias("_hi"), share(inside, held).alias("_held"),
        share(F.col("y").between(F.col("lo_cal"), F.col("hi_cal")), held).alias("_cal"))
    near = lambda c, level, by: F.abs(F.col(c) - level) <= by
    return s.select("model", "n_train", "n_held_out", (near("_lo", 10, 1) & near("_hi", 90, 1)).alias("levels_met"), near("_held", 80, 2).alias("held_out_met"),
                    (F.col("_cal") >= 78).alias("calibrated_met"))


@query("leaderboard", f"""
WITH s AS (SELECT model, avg(abs(pred - y) / y) * 100 AS m, sum(abs(pred - y)) / sum(y) * 100 AS w, sum(pred - y) / sum(y) * 100 AS b
  FROM v_lpred GROUP BY model)
SELECT model, {R('m')} AS mape, {R('w')} AS wape, {R('b')} AS bias_pct, CAST(row_number() OVER (ORDER BY m, model) AS INTEGER) AS rank,
  {R("(m / (SELECT m FROM s WHERE model = 'naive_7') - 1) * 100")} AS vs_production_pct FROM s""")
def leaderboard(spark, sf):
    s = E.metrics(I.long_predictions(spark, sf), ["model"]).select("model", "mape", "wape", "bias_pct")
    return out(E.leaderboard(s, "naive_7"))


@query("dashboard_views", f"""
SELECT 'forecast' AS page, 'hours' AS item, CAST(count(*) AS DOUBLE) AS value FROM v_best
UNION ALL SELECT 'accuracy', series, {R('avg(mape)')} FROM v_acc GROUP BY series
UNION ALL SELECT 'quality', reason, CAST(count(*) AS DOUBLE) FROM v_tagged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'models', model_version, {R('avg(abs_pct_error)')} FROM v_rec GROUP BY model_version""")
def dashboard_views(spark, sf):
    from flowgrid.queries.tables import tagged_readings

    log = I.forecast_log(spark, sf)
    rec = hourly(spark, sf)
    pages = [
        E.latest_forecast(log, ["series"]).agg(F.count("*").cast("double").alias("value")).select(
            F.lit("forecast").alias("page"), F.lit("hours").alias("item"), "value"),
        accuracy(spark, sf).groupBy(F.col("series").alias("item")).agg(F.avg("mape").alias("value")).select(
            F.lit("accuracy").alias("page"), "item", "value"),
        tagged_readings(spark, sf).where(F.col("reason").isNotNull()).groupBy(F.col("reason").alias("item")).agg(
            F.count("*").cast("double").alias("value")).select(F.lit("quality").alias("page"), "item", "value"),
        rec.groupBy(F.col("model_version").alias("item")).agg(F.avg("abs_pct_error").alias("value")).select(
            F.lit("models").alias("page"), "item", "value")]
    res = pages[0]
    for p in pages[1:]:
        res = res.unionByName(p)
    return out(res)


@query("dashboard_operations", f"""
WITH d AS (SELECT series, h // 24 AS day, count(*) AS forecast_hours, sum(predicted_m3) AS total, CAST(arg_max(h % 24, (predicted_m3, -h)) AS INTEGER) AS peak_hour
  FROM v_best GROUP BY series, h // 24),
l AS (SELECT series, max(day) AS day FROM d GROUP BY series),
a AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY forecast_day DESC) AS back FROM v_acc),
s AS (SELECT series, count(*) AS scored_days, max(forecast_day) AS scored_day, max(mape) FILTER (back = 1) AS last_mape,
  avg(mape) FILTER (back <= 7) AS recent_mape, max(mape) AS worst_mape FROM a GROUP BY series)
SELECT d.series, {DT('d.day')} AS date, forecast_hours, {R('total', 3)} AS forecast_total, peak_hour, scored_days, {DT('scored_day')} AS scored_date,
  {R('last_mape', 3)} AS last_mape, {R('recent_mape', 3)} AS recent_mape, {R('worst_mape', 3)} AS worst_mape FROM d JOIN l ON l.series = d.series AND l.day = d.day LEFT JOIN s ON s.series = d.series""")
def dashboard_operations(spark, sf):
    page = dashboard.operations(I.forecast_log(spark, sf), accuracy(spark, sf), ["series"])
    return out(page.withColumn("scored_day", day_date("scored_day")).withColumnRenamed("scored_day", "scored_date"), 3)


@query("dashboard_accuracy", f"""
SELECT series, CAST(h % 24 AS INTEGER) AS hour, count(*) AS hours, {R('avg(abs_pct_error)', 4)} AS mape,
  {R('sum(error_m3) / nullif(sum(actual_m3), 0) * 100', 4)} AS bias_pct, {R('avg(CAST(abs_pct_error > 20 AS INTEGER)) * 100', 4)} AS large_pct
FROM v_rec GROUP BY ALL""")
def dashboard_accuracy(spark, sf):
    return out(dashboard.accuracy(hourly(spark, sf), ["series"]), 4)


@query("dashboard_quality", f"""
SELECT series, {DT('h // 24')} AS date, count(*) AS rows, count(*) FILTER (reason IS NULL) AS clean, count(*) FILTER (reason = 'null_value') AS null_value,
  count(*) FILTER (reason = 'out_of_range') AS out_of_range, count(*) FILTER (reason = 'duplicate_key') AS duplicate_key,
  count(*) FILTER (reason = 'frozen_value') AS frozen_value FROM v_tagged GROUP BY ALL""")
def dashboard_quality(spark, sf):
    from flowgrid.operators.quality import ROW_RULES
    from flowgrid.queries.tables import tagged_readings

    return out(dashboard.quality(tagged_readings(spark, sf), ROW_RULES, ["series"]))


@query("dashboard_models", f"""
WITH i AS (SELECT model_version, CAST((h // 24 + 3) // 7 AS INTEGER) AS week, count(*) AS issued FROM v_log GROUP BY ALL),
u AS (SELECT model_version, CAST((h // 24 + 3) // 7 AS INTEGER) AS week, count(*) AS used, avg(abs_pct_error) AS mape FROM v_rec GROUP BY ALL)
SELECT i.model_version, i.week, issued, coalesce(used, 0) AS used, {R('mape', 4)} AS mape FROM i LEFT JOIN u ON u.model_version = i.model_version AND u.week = i.week""")
def dashboard_models(spark, sf):
    return out(dashboard.models(I.forecast_log(spark, sf), hourly(spark, sf), ["series"]), 4)
