"""Joins (C), aggregations (D), windows (E) and top-k (F) over the demand series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgrid.functions import scalars as S
from flowgrid.functions.timefns import day_date, day_of_hour, hour_of_day, hour_ts, weekday_of
from flowgrid.operators import evaluate as E
from flowgrid.operators import explore as X
from flowgrid.operators import features, series, vintages
from flowgrid.operators.quantiles import exact_quantile, exact_quantiles
from flowgrid.operators.series import DAY_CHUNK
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.queries.tables import DAY_TYPE
from flowgrid.sources import inputs as I


# ---- C ---------------------------------------------------------------------------------------------------------
@query("grid_fill_join", f"""
SELECT g.series, {TS('g.h')} AS ts, d.demand FROM v_grid g LEFT JOIN v_demand d ON d.series = g.series AND d.h = g.h""")
def grid_fill_join(spark, sf):
    return out(series.on_grid(I.demand(spark, sf), ["series"], "h"))


LAG_COLS = ", ".join(f"l{k}.demand AS lag_{k}h" for k in (48, 72, 168, 336, 504))
LAG_JOINS = " ".join(f"LEFT JOIN v_demand l{k} ON l{k}.series = t.series AND l{k}.h = t.h - {k}"
                     for k in (48, 72, 168, 336, 504))


@query("lag_self_join", f"SELECT t.series, {TS('t.h')} AS ts, {LAG_COLS} FROM v_grid t {LAG_JOINS}")
def lag_self_join(spark, sf):
    d = I.demand(spark, sf)
    tgt = series.grid(d, ["series"], "h")
    return out(series.lag_join(tgt, d, ["series"], "h", "demand", {f"lag_{k}h": k for k in (48, 72, 168, 336, 504)}))


@query("asof_vintage_join", f"""
SELECT {TS('t.h')} AS ts, {TS('p.issued_h')} AS issued, p.temperature, p.humidity, p.rain
FROM (SELECT DISTINCT h FROM v_total) t LEFT JOIN v_pick p ON p.h = t.h""")
def asof_vintage_join(spark, sf):
    pick = vintages.day_ahead_vintage(I.vintages(spark, sf), [], ["temperature", "humidity", "rain"], ["row_id"])
    tgt = I.demand_total(spark, sf).select("h")
    return out(tgt.join(pick, "h", "left").select("h", hour_ts("issued_h").alias("issued"), "temperature", "humidity",
                                                  "rain"))


@query("daily_lookup_join", f"""
WITH m AS (SELECT h // 24 AS day, avg(temperature) AS t FROM v_obs GROUP BY ALL)
SELECT d.series, {TS('d.h')} AS ts, {R('a.t')} AS t_day, {R('b.t')} AS t_prev, {R('c.t')} AS t_prev2
FROM v_demand d LEFT JOIN m a ON a.day = d.h // 24 LEFT JOIN m b ON b.day = d.h // 24 - 1
LEFT JOIN m c ON c.day = d.h // 24 - 2""")
def daily_lookup_join(spark, sf):
    mean = vintages.daily_mean(I.weather_obs(spark, sf), [], "temperature", "t_day")
    d = I.demand(spark, sf).withColumn("day", day_of_hour("h"))
    for n, name in ((0, "t_day"), (1, "t_prev"), (2, "t_prev2")):
        d = d.join(vintages.shift_days(mean, n, {"t_day": name}), "day", "left")
    return out(d.select("series", "h", "t_day", "t_prev", "t_prev2"))


@query("calendar_join", f"""
SELECT d.series, {TS('d.h')} AS ts, CAST(coalesce(c.is_public_holiday, false) AS INTEGER) AS is_holiday,
  CAST(coalesce(c.ramadan_day, 0) AS INTEGER) AS ramadan_day,
  CAST(coalesce(c.event_type = 'weather', false) AS INTEGER) AS event_weather
FROM v_demand d LEFT JOIN v_cal c ON c.day = d.h // 24""")
def calendar_join(spark, sf):
    d = features.calendar_features(I.demand(spark, sf).withColumn("day", day_of_hour("h")), I.calendar(spark, sf))
    return out(d.select("series", "h", *[F.col(c).cast("int") for c in ("is_holiday", "ramadan_day", "event_weather")]))


@query("label_join", f"""
SELECT t.series, {TS('t.h')} AS ts, l.demand AS lag_504h, t.demand AS y
FROM v_demand t JOIN v_demand l ON l.series = t.series AND l.h = t.h - 504""")
def label_join(spark, sf):
    d = I.demand(spark, sf)
    feats = series.lag_table(d, ["series"], "h", "demand", {"lag_504h": 504})
    return out(features.training_frame(feats, d, ["series"]).withColumnRenamed("demand", "y").select(
        "series", "h", "lag_504h", "y"))


@query("reconcile_join", f"""
SELECT series, {TS('h')} AS ts, model_version, predicted_m3, actual_m3, {R('error_m3')} AS error_m3 FROM v_rec""")
def reconcile_join(spark, sf):
    return out(E.reconcile(I.forecast_log(spark, sf), I.demand(spark, sf), ["series"]).select(
        "series", "h", "model_version", "predicted_m3", "actual_m3", "error_m3"))


@query("semi_join_days", f"""
SELECT series, {TS('h')} AS ts, demand FROM v_demand
WHERE h // 24 IN (SELECT day FROM v_cal WHERE is_public_holiday OR event_type = 'weather')""")
def semi_join_days(spark, sf):
    days = I.calendar(spark, sf).where(F.col("is_public_holiday") | (F.col("event_type") == "weather")).select("day")
    d = I.demand(spark, sf).withColumn("day", day_of_hour("h"))
    return out(d.join(days, "day", "left_semi").drop("day"))


@query("past_folds_join", f"""
SELECT f.fold AS for_fold, count(*) AS n, {R('sum(p.y)', 2)} AS y_sum
FROM (SELECT DISTINCT fold FROM v_lpred) f JOIN v_lpred p ON p.fold < f.fold GROUP BY ALL""")
def past_folds_join(spark, sf):
    return out(E.past_sums(I.long_predictions(spark, sf), [], {"n": F.count("*"), "y_sum": F.sum("y")}), 2)


@query("fold_assign_join", f"""
WITH e AS (SELECT (max(h // 24) + 1) * 24 AS hi FROM v_demand),
f AS (SELECT fold, hi - (3 - fold) * 72 AS a, hi - (3 - fold) * 72 + 72 AS b FROM e, (SELECT unnest([0, 1, 2]) AS fold))
SELECT series, {TS('h')} AS ts, CAST(fold AS INTEGER) AS fold, CASE WHEN h < a THEN 'train' ELSE 'test' END AS part
FROM v_demand, f WHERE h < b""")
def fold_assign_join(spark, sf):
    return out(E.rolling_origin(I.demand(spark, sf), 3, 3).select("series", "h", "fold", "part"))


@query("model_outputs_join", f"""
SELECT series, {TS('h')} AS ts, y, {R('naive_48')} AS naive_48, {R('naive_168')} AS naive_168, {R('mean_3w')} AS mean_3w
FROM v_wide""")
def model_outputs_join(spark, sf):
    return out(E.pivot_models(I.predictions(spark, sf), ["series", "h"], I.MODELS))


@query("obs_fcst_join", f"""
SELECT {TS('p.h')} AS ts, {R('p.temperature - o.temperature')} AS t_err FROM v_pick p JOIN v_obs o ON o.h = p.h""")
def obs_fcst_join(spark, sf):
    pick = vintages.day_ahead_vintage(I.vintages(spark, sf), [], ["temperature"], ["row_id"])
    both = pick.join(I.weather_obs(spark, sf).select("h", F.col("temperature").alias("obs")), "h")
    return out(both.select("h", (F.col("temperature") - F.col("obs")).alias("t_err")))


# ---- D ---------------------------------------------------------------------------------------------------------
@query("agg_minmax_scalar", f"SELECT {TS('min(h)')} AS first_ts, {TS('max(h)')} AS last_ts, {DT('max(h // 24)')} AS last_day FROM v_ev")
def agg_minmax_scalar(spark, sf):
    one = I.events(spark, sf).agg(F.min("h").alias("a"), F.max("h").alias("b"))
    return one.select(hour_ts("a").alias("first_ts"), hour_ts("b").alias("last_ts"),
                      day_date(day_of_hour("b")).alias("last_day"))


@query("agg_daily", f"""
SELECT series, {DT('h // 24')} AS date, {R('avg(demand)')} AS mean, max(demand) AS max, min(demand) AS min,
  {R('sum(demand)')} AS total, arg_min(demand, h) AS first FROM v_demand GROUP BY ALL""")
def agg_daily(spark, sf):
    return out(I.demand(spark, sf).groupBy("series", day_of_hour("h").alias("day")).agg(
        F.avg("demand").alias("mean"), F.max("demand").alias("max"), F.min("demand").alias("min"),
        F.sum("demand").alias("total"), F.min_by("demand", "h").alias("first")))


@query("agg_sum_min_count", f"""
SELECT series, {TS('h')} AS ts, {R('sum(demand)')} AS total, count(demand) AS present FROM v_readings GROUP BY ALL""")
def agg_sum_min_count(spark, sf):
    return out(I.readings(spark, sf).groupBy("series", "h").agg(F.sum("demand").alias("total"),
                                                                F.count("demand").alias("present")))


@query("agg_monthly_yearly", f"""
WITH yr AS (SELECT year({DT('day')}) AS year, avg(y) AS mean, median(y) AS median, min(y) AS min, max(y) AS max
  FROM v_daily GROUP BY ALL)
SELECT CAST(year AS INTEGER) AS year, {R('mean', 2)} AS mean, {R('median', 2)} AS median, {R('min', 2)} AS min,
  {R('max', 2)} AS max, {R('(mean / lag(mean) OVER (ORDER BY year) - 1) * 100')} AS growth_pct FROM yr""")
def agg_monthly_yearly(spark, sf):
    d = I.daily_long(spark, sf).withColumn("year", F.year(day_date("day")))
    yr = d.groupBy("year").agg(F.avg("y").alias("mean"), F.median("y").alias("median"), F.min("y").alias("min"),
                               F.max("y").alias("max"))
    growth = (F.col("mean") / F.lag("mean").over(Window.orderBy("year")) - 1) * 100
    pct = out(yr.select("year", growth.alias("growth_pct")))
    return out(yr, 2).join(pct, "year")


@query("agg_monthly", f"""
SELECT CAST(date_trunc('month', {DT('day')}) AS DATE) AS month, {R('avg(y)', 2)} AS mean, count(*) AS days
FROM v_daily GROUP BY ALL""")
def agg_monthly(spark, sf):
    return out(I.daily_long(spark, sf).groupBy(F.trunc(day_date("day"), "month").alias("month")).agg(
        F.avg("y").alias("mean"), F.count("*").alias("days")), 2)


@query("agg_count_distinct", """
SELECT series, count(DISTINCT h) AS hours, count(DISTINCT h // 24) AS days, count(DISTINCT user_id) AS users
FROM v_ev GROUP BY series""")
def agg_count_distinct(spark, sf):
    return I.events(spark, sf).groupBy("series").agg(
        F.count_distinct("h").alias("hours"), F.count_distinct(day_of_hour("h")).alias("days"),
        F.count_distinct("user_id").alias("users"))


@query("agg_pivot", f"""
SELECT CAST(h % 24 AS INTEGER) AS hour, {', '.join(R(f"avg(demand) FILTER ((h // 24 + 3) % 7 = {k})") + f' AS dow_{k}'
                                                  for k in range(7))} FROM v_demand GROUP BY ALL""")
def agg_pivot(spark, sf):
    d = I.demand(spark, sf).select("demand", hour_of_day("h").alias("hour"), weekday_of(day_of_hour("h")).alias("dow"))
    p = d.groupBy("hour").pivot("dow", list(range(7))).agg(F.avg("demand"))
    return out(p.withColumnsRenamed({str(k): f"dow_{k}" for k in range(7)}))


@query("agg_crosstab", """
SELECT p.rain > 0.1 AS forecast_rain, o.rain > 0.1 AS observed_rain, count(*) AS hours
FROM v_pick p JOIN v_obs o ON o.h = p.h GROUP BY ALL""")
def agg_crosstab(spark, sf):
    pick = vintages.day_ahead_vintage(I.vintages(spark, sf), [], ["rain"], ["row_id"])
    both = pick.select("h", (F.col("rain") > 0.1).alias("forecast_rain")).join(
        I.weather_obs(spark, sf).select("h", (F.col("rain") > 0.1).alias("observed_rain")), "h")
    return both.groupBy("forecast_rain", "observed_rain").agg(F.count("*").alias("hours"))


NOTE = "CASE WHEN demand IS NULL THEN 'telemetry gap' WHEN demand > 200 THEN 'spike' ELSE 'ok' END"


@query("agg_value_counts", f"""
SELECT note, count(*) AS n, {R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct, min(demand) AS demand_min,
  max(demand) AS demand_max FROM (SELECT {NOTE} AS note, demand FROM v_readings) GROUP BY note""")
def agg_value_counts(spark, sf):
    notes = I.feeds(spark, sf)["consumption"].select(F.coalesce("quality_note", F.lit("ok")).alias("note"), "demand_m3h")
    per = notes.groupBy("note").agg(F.count("*").alias("n"), F.min("demand_m3h").alias("demand_min"),
                                    F.max("demand_m3h").alias("demand_max"))
    total = per.agg(F.sum("n").alias("t")).select("t").scalar()
    return out(per.withColumn("pct", F.col("n") * 100.0 / total))


@query("agg_argmax", f"""
SELECT series, CAST(arg_max(hour, m) AS INTEGER) AS peak_hour, CAST(arg_min(hour, m) AS INTEGER) AS trough_hour,
  {R('max(m) / min(m)')} AS peak_trough FROM (
    SELECT series, h % 24 AS hour, avg(demand) AS m FROM v_demand GROUP BY ALL) GROUP BY series""")
def agg_argmax(spark, sf):
    prof = I.demand(spark, sf).groupBy("series", hour_of_day("h").alias("hour")).agg(F.avg("demand").alias("m"))
    return out(prof.groupBy("series").agg(
        F.max_by("hour", "m").alias("peak_hour"), F.min_by("hour", "m").alias("trough_hour"),
        S.ratio(F.max("m"), F.min("m")).alias("peak_trough")))


@query("agg_corr", f"""
SELECT {R('corr(temperature, humidity)')} AS t_hum, {R('corr(temperature, rain)')} AS t_rain,
  {R('corr(d.demand, temperature)')} AS y_t FROM v_total d JOIN v_obs o ON o.h = d.h""")
def agg_corr(spark, sf):
    both = I.demand_total(spark, sf).join(I.weather_obs(spark, sf), "h")
    return out(both.agg(F.corr("temperature", "humidity").alias("t_hum"), F.corr("temperature", "rain").alias("t_rain"),
                        F.corr("demand", "temperature").alias("y_t")))


@query("agg_quantile", f"""
SELECT series, {R('quantile_cont(demand, 0.9)')} AS q90, {R('quantile_cont(demand, 0.5)')} AS q50 FROM v_readings GROUP BY series""")
def agg_quantile(spark, sf):
    r = I.readings(spark, sf)
    return out(exact_quantiles(r, ["series"], "demand", {"q90": 0.9, "q50": 0.5}))


@query("agg_quantile_global", f"SELECT {R('quantile_cont(l_extendedprice, 0.9)', 3)} AS q90 FROM lineitem")
def agg_quantile_global(spark, sf):
    return out(exact_quantile(I.table(spark, sf, "lineitem"), [], "l_extendedprice", 0.9, "q90"), 3)


@query("agg_describe", f"""
SELECT series, count(demand) AS n, {R('avg(demand)')} AS mean, {R('stddev_samp(demand)')} AS std, min(demand) AS min,
  max(demand) AS max, {R('skewness(demand)')} AS skew, {R('stddev_samp(demand) / avg(demand) * 100')} AS cv_pct
FROM v_demand GROUP BY series""")
def agg_describe(spark, sf):
    return out(X.describe(I.demand(spark, sf), ["series"], "demand"))


@query("agg_weighted_ratio", f"""
SELECT series, model, {R('sum(abs(pred - y)) / nullif(sum(abs(y)), 0) * 100')} AS wape,
  {R('sum(pred - y) / nullif(sum(y), 0) * 100')} AS bias_pct FROM v_pred GROUP BY ALL""")
def agg_weighted_ratio(spark, sf):
    return out(I.predictions(spark, sf).groupBy("series", "model").agg(E.wape().alias("wape"),
                                                                       E.bias_pct().alias("bias_pct")))


@query("agg_grouped_apply", f"""
SELECT series, {DT('forecast_day')} AS date, hours_scored, {R('mape')} AS mape, {R('bias_pct')} AS bias_pct FROM v_acc""")
def agg_grouped_apply(spark, sf):
    hourly = E.reconcile(I.forecast_log(spark, sf), I.demand(spark, sf), ["series"])
    acc = E.daily_accuracy(hourly, ["series"])
    return out(acc.select("series", F.col("forecast_day").alias("day"), "hours_scored", "mape", "bias_pct"))


@query("agg_first_last_span", f"""
SELECT ramadan_block, arg_min(holiday_name, day) FILTER (holiday_name IS NOT NULL) AS first_holiday, min(date) AS first_date,
  max(date) AS last_date, count(DISTINCT day) AS days, count(*) AS orders
FROM (SELECT *, CAST((day - ramadan_day) AS BIGINT) AS ramadan_block FROM v_oday WHERE is_ramadan) GROUP BY ALL""")
def agg_first_last_span(spark, sf):
    cal = I.order_days(spark, sf).where("is_ramadan")
    return cal.groupBy((F.col("day") - F.col("ramadan_day")).cast("bigint").alias("ramadan_block")).agg(
        F.min_by("holiday_name", F.when(F.col("holiday_name").isNotNull(), F.col("day"))).alias("first_holiday"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("day").alias("days"),
        F.count("*").alias("orders"))


@query("agg_idxmin_counts", """
SELECT model, count(*) AS folds_best FROM (
  SELECT fold, arg_min(model, m) AS model FROM (
    SELECT fold, model, avg(abs(pred - y) / y) AS m FROM v_lpred GROUP BY ALL) GROUP BY fold) GROUP BY model""")
def agg_idxmin_counts(spark, sf):
    per = I.long_predictions(spark, sf).groupBy("fold", "model").agg(E.mape().alias("m"))
    best = per.groupBy("fold").agg(F.min_by("model", "m").alias("model"))
    return best.groupBy("model").agg(F.count("*").alias("folds_best"))


# ---- E ---------------------------------------------------------------------------------------------------------
ROLL = "(PARTITION BY series ORDER BY h RANGE BETWEEN 215 PRECEDING AND 48 PRECEDING)"


@query("win_rolling_7d", f"""
SELECT series, {TS('h')} AS ts,
  {R(f'CASE WHEN count(demand) OVER {ROLL} >= 120 THEN avg(demand) OVER {ROLL} END')} AS roll_mean,
  {R(f'CASE WHEN count(demand) OVER {ROLL} >= 120 THEN stddev_samp(demand) OVER {ROLL} END')} AS roll_std FROM v_demand""")
def win_rolling_7d(spark, sf):
    return out(series.rolling(I.demand(spark, sf), ["series"], "h", "demand", 168, 48, 120).drop("demand"))


@query("win_same_hour_mean", f"""
SELECT t.series, {TS('t.h')} AS ts, {R('(a.demand + b.demand + c.demand) / 3')} AS same_hour_mean
FROM v_demand t LEFT JOIN v_demand a ON a.series = t.series AND a.h = t.h - 168
LEFT JOIN v_demand b ON b.series = t.series AND b.h = t.h - 336
LEFT JOIN v_demand c ON c.series = t.series AND c.h = t.h - 504""")
def win_same_hour_mean(spark, sf):
    d = I.demand(spark, sf)
    j = series.lag_join(d.select("series", "h"), d, ["series"], "h", "demand", {"a": 168, "b": 336, "c": 504})
    return out(j.select("series", "h", ((F.col("a") + F.col("b") + F.col("c")) / 3).alias("same_hour_mean")))


@query("win_day_broadcast", f"""
SELECT series, {TS('h')} AS ts, max(demand) OVER w AS day_max, {R('sum(demand) OVER w')} AS day_total FROM v_demand
WINDOW w AS (PARTITION BY series, h // 24)""")
def win_day_broadcast(spark, sf):
    w = Window.partitionBy("series", "_day")
    d = I.demand(spark, sf).withColumn("_day", day_of_hour("h"))
    return out(d.select("series", "h", F.max("demand").over(w).alias("day_max"),
                        F.sum("demand").over(w).alias("day_total")))


@query("win_latest_wins", f"""
SELECT series, {TS('h')} AS ts, arg_max(row_id, row_id) AS row_id, arg_max(coalesce(demand, -1), row_id) AS demand
FROM v_readings GROUP BY ALL""")
def win_latest_wins(spark, sf):
    df = series.latest_wins(I.readings(spark, sf), ["series", "h"], ["row_id"])
    return out(df.withColumn("demand", F.coalesce("demand", F.lit(-1.0))))


@query("win_gaps_islands", f"""
WITH b AS (SELECT series, h, n, CASE WHEN n = lag(n) OVER w AND h - lag(h) OVER w = 1 THEN 0 ELSE 1 END AS brk
  FROM v_counts WINDOW w AS (PARTITION BY series ORDER BY h)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY h) AS run FROM b)
SELECT series, {TS('min(h)')} AS run_start, count(*) AS run_len FROM r GROUP BY series, run""")
def win_gaps_islands(spark, sf):
    c = I.counts(spark, sf)
    brk = (F.col("n") != F.col("prev_n")) | (F.col("h") - F.col("prev_p") != 1)
    tagged = series.runs(c, ["series"], "h", brk, {"n": F.col("n"), "p": F.col("h")})
    return series.run_lengths(tagged, ["series"], "h").select("series", hour_ts("run_start").alias("run_start"), "run_len")


CENTRED = {"m7": (7, 7), "m28": (28, 14), "m30": (30, 30), "m365": (365, 180)}


def _centred_sql() -> str:
    parts = []
    for name, (width, least) in CENTRED.items():
        w = f"(ORDER BY day RANGE BETWEEN {width // 2} PRECEDING AND {(width - 1) // 2} FOLLOWING)"
        parts.append(R(f"CASE WHEN count(y) OVER {w} >= {least} THEN avg(y) OVER {w} END", 2) + f" AS {name}")
    return ", ".join(parts)


@query("win_centered_mean", f"SELECT {DT('day')} AS date, {_centred_sql()} FROM v_daily")
def win_centered_mean(spark, sf):
    frames = {}
    for name, (width, _) in CENTRED.items():
        lo, hi = -(width // 2), (width - 1) // 2
        frames[f"{name}_n"] = (lo, hi, lambda w: F.count("y").over(w))
        frames[f"{name}_v"] = (lo, hi, lambda w: F.avg("y").over(w))
    d = series.banded(I.daily_long(spark, sf), [], "day", frames, DAY_CHUNK)
    return out(d.select("day", *[F.when(F.col(f"{n}_n") >= least, F.col(f"{n}_v")).alias(n)
                                 for n, (_, least) in CENTRED.items()]), 2)


@query("win_yoy", f"""
WITH s AS (SELECT day, CASE WHEN count(y) OVER w >= 28 THEN avg(y) OVER w END AS level FROM v_daily
  WINDOW w AS (ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING))
SELECT {DT('a.day')} AS date, {R('(a.level / b.level - 1) * 100')} AS yoy_pct FROM s a JOIN s b ON b.day = a.day - 364""")
def win_yoy(spark, sf):
    return out(X.yoy(I.daily_long(spark, sf), []).select("day", "yoy_pct"))


@query("win_diff", f"""
SELECT t.series, {TS('t.h')} AS ts, {R('t.demand - a.demand')} AS diff_24, {R('t.demand - b.demand')} AS diff_168
FROM v_demand t LEFT JOIN v_demand a ON a.series = t.series AND a.h = t.h - 24
LEFT JOIN v_demand b ON b.series = t.series AND b.h = t.h - 168""")
def win_diff(spark, sf):
    d = I.demand(spark, sf)
    j = series.banded(d, ["series"], "h", {"a": (-24, -24, lambda w: F.max("demand").over(w)),
                                           "b": (-168, -168, lambda w: F.max("demand").over(w))})
    return out(j.select("series", "h", (F.col("demand") - F.col("a")).alias("diff_24"),
                        (F.col("demand") - F.col("b")).alias("diff_168")))


@query("win_event_blocks", f"""
WITH e AS (SELECT *, CASE WHEN event_name = lag(event_name) OVER w AND day - lag(day) OVER w = 1 THEN 0 ELSE 1 END AS brk
  FROM v_lcal WHERE event_type IS NOT NULL WINDOW w AS (ORDER BY day)),
r AS (SELECT *, sum(brk) OVER (ORDER BY day) AS run FROM e),
b AS (SELECT arg_min(event_name, day) AS event, min(day) AS a, max(day) AS z, min(date) AS first_date, max(date) AS last_date, count(*) AS days FROM r GROUP BY run)
SELECT event, first_date, last_date, days, count(o_orderkey) AS orders FROM b LEFT JOIN v_oday o ON o.day BETWEEN a AND z GROUP BY ALL""")
def win_event_blocks(spark, sf):
    b = X.event_blocks(I.long_calendar(spark, sf))
    per_day = I.order_days(spark, sf).groupBy("day").agg(F.count("*").alias("orders"))
    days = b.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).join(per_day, "day", "left")
    return days.groupBy("event", day_date("first_day").alias("first_date"), day_date("last_day").alias("last_date"), "days").agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))


@query("win_last_n_all", """
SELECT series, count(*) AS days, bool_and(mape > 50) AS all_above FROM (
  SELECT * FROM v_acc QUALIFY row_number() OVER (PARTITION BY series ORDER BY forecast_day DESC) <= 3) GROUP BY series""")
def win_last_n_all(spark, sf):
    from flowgrid.operators.decide import needs_retrain

    acc = E.daily_accuracy(E.reconcile(I.forecast_log(spark, sf), I.demand(spark, sf), ["series"]), ["series"])
    return needs_retrain(acc, ["series"], F.lit(40.0)).select("series", "days", F.col("all_worse").alias("all_above"))


@query("win_rank_board", f"""
SELECT model, {R('m')} AS mape, CAST(row_number() OVER (ORDER BY m, model) AS INTEGER) AS rank FROM (
  SELECT model, avg(abs(pred - y) / y) * 100 AS m FROM v_lpred GROUP BY model)""")
def win_rank_board(spark, sf):
    s = I.long_predictions(spark, sf).groupBy("model").agg(E.mape().alias("mape"))
    return out(E.leaderboard(s, "naive_7").select("model", "mape", "rank"))


@query("win_interpolate", f"""
WITH g AS (SELECT g.series, g.h, d.demand FROM v_grid g LEFT JOIN v_demand d ON d.series = g.series AND d.h = g.h),
n AS (SELECT *, last_value(CASE WHEN demand IS NOT NULL THEN h END IGNORE NULLS) OVER b AS ph,
    last_value(demand IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN demand IS NOT NULL THEN h END IGNORE NULLS) OVER a AS nh,
    first_value(demand IGNORE NULLS) OVER a AS nv FROM g
  WINDOW b AS (PARTITION BY series ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY series ORDER BY h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series, {TS('h')} AS ts, {R('''CASE WHEN demand IS NOT NULL THEN demand
  WHEN h - ph <= 6 THEN CASE WHEN nh IS NULL THEN pv ELSE pv + (nv - pv) * ((h - ph) / (nh - ph)) END END''')} AS filled FROM n""")
def win_interpolate(spark, sf):
    g = series.on_grid(I.demand(spark, sf), ["series"], "h")
    return out(series.interpolate(g, ["series"], "h", "demand", 6).select("series", "h", "filled"))


@query("win_last_n_same_class", f"""
WITH d AS (SELECT l.day, l.y, (c.is_weekend OR c.is_public_holiday) AS off FROM v_daily l JOIN v_lcal c ON c.day = l.day),
c AS (SELECT day, avg(y) AS m, count(*) AS n FROM (
  SELECT t.day, p.y FROM d t JOIN d p ON p.day <= t.day - 2 AND p.off = t.off
  QUALIFY row_number() OVER (PARTITION BY t.day ORDER BY p.day DESC) <= 8) GROUP BY day),
n AS (SELECT day, avg(y) AS m FROM (
  SELECT t.day, p.y FROM d t JOIN d p ON p.day <= t.day - 2
  QUALIFY row_number() OVER (PARTITION BY t.day ORDER BY p.day DESC) <= 8) GROUP BY day)
SELECT {DT('d.day')} AS date, {R('CASE WHEN coalesce(c.n, 0) >= 3 THEN c.m ELSE n.m END', 2)} AS level
FROM d LEFT JOIN c ON c.day = d.day LEFT JOIN n ON n.day = d.day""")
def win_last_n_same_class(spark, sf):
    cal = I.long_calendar(spark, sf).select("day", (F.col("is_weekend") | F.col("is_public_holiday")).alias("off"))
    d = I.daily_long(spark, sf).join(cal, "day")
    past = X.class_history(d, [], "off").join(d.select(F.col("day").alias("src_day"), "y"), "src_day")
    level = past.groupBy("day").agg(F.avg("y").alias("level"))
    return out(d.select("day").join(level, "day", "left"), 2)


@query("win_week_of_period", f"""
SELECT CAST((ramadan_day - 1) // 7 + 1 AS INTEGER) AS week, {R('avg(l.y)', 2)} AS mean, count(*) AS days
FROM v_daily l JOIN v_lcal c ON c.day = l.day WHERE c.is_ramadan GROUP BY ALL""")
def win_week_of_period(spark, sf):
    d = I.daily_long(spark, sf).join(I.long_calendar(spark, sf).where("is_ramadan").select("day", "ramadan_day"), "day")
    week = (F.floor((F.col("ramadan_day") - 1) / 7) + 1).cast("int").alias("week")
    return out(d.groupBy(week).agg(F.avg("y").alias("mean"), F.count("*").alias("days")), 2)


# ---- F ---------------------------------------------------------------------------------------------------------
@query("topk_abs_residual", f"""
SELECT {DT('day')} AS date, {R('(y / level - 1) * 100')} AS residual_pct FROM v_llevel WHERE level IS NOT NULL
ORDER BY abs(y / level - 1) DESC, day LIMIT 15""")
def topk_abs_residual(spark, sf):
    lvl = X.local_level(I.daily_long(spark, sf), []).where(F.col("level").isNotNull())
    r = lvl.select("day", ((F.col("y") / F.col("level") - 1) * 100).alias("residual_pct"))
    return out(r.orderBy(F.abs("residual_pct").desc(), "day").limit(15))


@query("topk_worst_days", f"""
WITH w AS (SELECT day, avg(abs(pred - y) / y) * 100 AS mape, any_value(y) AS y FROM v_lpred WHERE model = 'mean_3w'
  GROUP BY day ORDER BY mape DESC, day LIMIT 10)
SELECT c.date, {R('w.mape')} AS mape, {DAY_TYPE.replace('is_', 'c.is_')} AS day_type, c.event_name FROM w JOIN v_lcal c ON c.day = w.day""")
def topk_worst_days(spark, sf):
    p = I.long_predictions(spark, sf).where(F.col("model") == "mean_3w")
    worst = E.daily_losses(p, [], F.col("day")).orderBy(F.desc("loss"), "day").limit(10)
    cal = I.long_calendar(spark, sf).select("day", X.day_type().alias("day_type"), "event_name")
    return out(worst.withColumnRenamed("loss", "mape").join(cal, "day"))
