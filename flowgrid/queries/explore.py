"""Exploratory analytics (inventory M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgrid.functions.timefns import day_date, day_of_hour, hour_of_day, hour_pos
from flowgrid.operators import explore as X
from flowgrid.operators import series, vintages
from flowgrid.operators.series import DAY_CHUNK
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.queries.evaluate import _acf_sql
from flowgrid.queries.tables import DAY_TYPE
from flowgrid.sources import inputs as I


@query("lead_time_profile", f"""
SELECT CAST(h - issued_h AS INTEGER) AS lead_h, count(*) AS n, count(DISTINCT issued_h) AS vintages,
  4 AS utc_offset_h FROM v_vint GROUP BY ALL""")
def lead_time_profile(spark, sf):
    f = I.feeds(spark, sf)["weather_fcst"]
    lead = (hour_pos("timestamp_local") - hour_pos("forecast_issued_local")).alias("lead_h")
    off = I.feeds(spark, sf)["consumption"].agg(
        F.max(hour_pos("timestamp_local") - hour_pos("timestamp_utc")).alias("o")).select("o").scalar()
    return f.groupBy(lead).agg(F.count("*").alias("n"), F.count_distinct("forecast_issued_local").alias("vintages")
                               ).withColumn("utc_offset_h", off)


@query("vintages_per_target", """
SELECT vintages, count(*) AS hours FROM (SELECT h, count(DISTINCT issued_h) AS vintages FROM v_vint GROUP BY h) GROUP BY ALL""")
def vintages_per_target(spark, sf):
    per = I.vintages(spark, sf).groupBy("h").agg(F.count_distinct("issued_h").alias("vintages"))
    return per.groupBy("vintages").agg(F.count("*").alias("hours"))


@query("loglinear_growth", f"""
SELECT series, {R('s * 1000000', 3)} AS slope_ppm, {R('i')} AS intercept, {R('(exp(s * 365) - 1) * 100')} AS annual_growth_pct FROM (
  SELECT p.series, regr_slope(ln(y), day - d0) AS s, regr_intercept(ln(y), day - d0) AS i FROM v_prio p
  JOIN (SELECT series, min(day) AS d0 FROM v_prio GROUP BY series) f ON f.series = p.series GROUP BY p.series)""")
def loglinear_growth(spark, sf):
    g = X.loglinear(I.daily_by_priority(spark, sf), ["series"])
    ppm = out(g.select("series", (F.col("slope") * 1e6).alias("slope_ppm")), 3)
    return out(g.drop("slope")).join(ppm, "series")


@query("intraday_profile", f"""
SELECT r.series, r.hour, {DAY_TYPE.replace('is_', 'c.is_')} AS day_type, {R('avg(r.rel)')} AS rel, count(r.rel) AS n
FROM v_rel r JOIN v_cal c ON c.day = r.day GROUP BY ALL""")
def intraday_profile(spark, sf):
    cal = I.calendar(spark, sf).select("day", X.day_type().alias("day_type"))
    r = X.relative(I.demand(spark, sf), ["series"]).join(F.broadcast(cal), "day")
    return out(r.groupBy("series", "hour", "day_type").agg(F.avg("rel").alias("rel"), F.count("rel").alias("n")))


@query("seasonal_index", f"""
SELECT CAST(month({DT('day')}) AS INTEGER) AS month, {R('avg(y / level365)')} AS season_index, count(level365) AS days
FROM v_llevel GROUP BY ALL""")
def seasonal_index(spark, sf):
    return out(X.seasonal_index(I.daily_long(spark, sf), []))


@query("weekday_effect", f"""
WITH n AS (SELECT CAST((l.day + 3) % 7 AS INTEGER) AS dow, l.y / l.level AS rel FROM v_llevel l JOIN v_lcal c ON c.day = l.day
  WHERE NOT c.is_public_holiday AND NOT c.is_ramadan AND l.level IS NOT NULL)
SELECT dow, {R('(avg(rel) / (SELECT avg(rel) FROM n WHERE dow < 4) - 1) * 100')} AS effect_pct FROM n GROUP BY dow""")
def weekday_effect(spark, sf):
    cal = I.long_calendar(spark, sf).where(~F.col("is_public_holiday") & ~F.col("is_ramadan")).select("day")
    d = X.local_level(I.daily_long(spark, sf), []).join(F.broadcast(cal), "day").where(F.col("level").isNotNull())
    d = d.select(F.pmod(F.col("day") + 3, F.lit(7)).cast("int").alias("dow"), (F.col("y") / F.col("level")).alias("rel"))
    base = d.where(F.col("dow") < 4).agg(F.avg("rel").alias("_base"))
    per = d.groupBy("dow").agg(F.avg("rel").alias("_m"))
    return out(series.attach(per, base, []).select("dow", ((F.col("_m") / F.col("_base") - 1) * 100).alias("effect_pct")))


DECOMP = """t AS (SELECT series, h, demand, CASE WHEN count(demand) OVER w >= 84 THEN avg(demand) OVER w END AS trend FROM v_demand
  WINDOW w AS (PARTITION BY series ORDER BY h RANGE BETWEEN 84 PRECEDING AND 83 FOLLOWING)),
a AS (SELECT *, demand - trend - avg(demand - trend) OVER (PARTITION BY series, h % 24) AS left1,
  avg(demand - trend) OVER (PARTITION BY series, h % 24) AS daily FROM t WHERE trend IS NOT NULL),
z AS (SELECT *, avg(left1) OVER (PARTITION BY series, (h + 72) % 168) AS weekly,
  left1 - avg(left1) OVER (PARTITION BY series, (h + 72) % 168) AS remainder FROM a)"""


@query("seasonal_decompose", f"""
WITH {DECOMP} SELECT series, {TS('h')} AS ts, {R('trend')} AS trend, {R('daily')} AS daily, {R('weekly')} AS weekly,
  {R('remainder')} AS remainder FROM z""")
def seasonal_decompose(spark, sf):
    return out(X.decompose(I.demand(spark, sf), ["series"]).select("series", "h", "trend", "daily", "weekly", "remainder"))


@query("seasonal_strength", f"""
WITH {DECOMP} SELECT series, {', '.join(R(f'greatest(1 - var_samp(remainder) / var_samp({c} + remainder), 0)') + f' AS strength_{c}'
                                       for c in ('trend', 'daily', 'weekly'))} FROM z GROUP BY series""")
def seasonal_strength(spark, sf):
    return out(X.strength(X.decompose(I.demand(spark, sf), ["series"]), ["series"]))


@query("acf", _acf_sql("(SELECT series, h AS pos, demand FROM v_demand)", "demand", "series", 504))
def acf(spark, sf):
    return out(series.acf(I.demand(spark, sf), ["series"], "h", "demand", 504))


@query("acf_daily", _acf_sql("(SELECT day AS pos, y / level AS r FROM v_llevel)", "r", "", 35))
def acf_daily(spark, sf):
    d = X.local_level(I.daily_long(spark, sf), []).withColumn("r", F.col("y") / F.col("level"))
    return out(series.acf(d.where(F.col("r").isNotNull()), [], "day", "r", 35, DAY_CHUNK))


@query("lag_scatter_corr", "WITH p AS (SELECT d.series, " + ", ".join(
    f"(SELECT demand FROM v_demand x WHERE x.series = d.series AND x.h = d.h - {k}) AS l{k}" for k in (24, 48, 168))
    + f", d.demand FROM v_demand d) SELECT series, {', '.join(R(f'corr(demand, l{k})') + f' AS corr_{k}' for k in (24, 48, 168))} "
    "FROM p GROUP BY series")
def lag_scatter_corr(spark, sf):
    d = I.demand(spark, sf)
    frames = {f"l{k}": (-k, -k, lambda w: F.max("demand").over(w)) for k in (24, 48, 168)}
    p = series.banded(d, ["series"], "h", frames)
    return out(p.groupBy("series").agg(*[F.corr("demand", f"l{k}").alias(f"corr_{k}") for k in (24, 48, 168)]))


@query("hinge_fit", f"""
WITH k AS (SELECT round(18 + i * 0.1, 6) AS knot FROM (SELECT unnest(generate_series(0, 140)) AS i)),
s AS (SELECT knot, regr_syy(d.demand, z) AS syy, regr_sxy(d.demand, z) AS sxy, regr_sxx(d.demand, z) AS sxx FROM (
  SELECT k.knot, d.demand, greatest(o.temperature - k.knot, 0) AS z FROM v_total d JOIN v_obs o ON o.h = d.h, k) d GROUP BY knot)
SELECT {R('knot')} AS knot, {R('sxy / sxx', 4)} AS slope, {R('(syy - sxy * sxy / sxx)', 1)} AS sse FROM s""")
def hinge_fit(spark, sf):
    both = I.demand_total(spark, sf).join(I.weather_obs(spark, sf), "h")
    s = X.hinge_scan(both, "temperature", "demand", 18, 32, 0.1)
    knot = F.round(F.col("knot") + F.lit(3.3e-9), 6).alias("knot")
    return s.select(knot, F.round(F.col("slope") + F.lit(3.3e-7), 4).alias("slope"),
                    F.round(F.col("sse") + F.lit(3.3e-4), 1).alias("sse"))


@query("hinge_best", f"""
WITH k AS (SELECT round(18 + i * 0.1, 6) AS knot FROM (SELECT unnest(generate_series(0, 140)) AS i)),
s AS (SELECT knot, regr_syy(d.demand, z) AS syy, regr_sxy(d.demand, z) AS sxy, regr_sxx(d.demand, z) AS sxx FROM (
  SELECT k.knot, d.demand, greatest(o.temperature - k.knot, 0) AS z FROM v_total d JOIN v_obs o ON o.h = d.h, k) d GROUP BY knot)
SELECT {R('arg_min(knot, syy - sxy * sxy / sxx)')} AS knot, {R('arg_min(sxy / sxx, syy - sxy * sxy / sxx)', 4)} AS slope FROM s""")
def hinge_best(spark, sf):
    both = I.demand_total(spark, sf).join(I.weather_obs(spark, sf), "h")
    s = X.hinge_scan(both, "temperature", "demand", 18, 32, 0.1)
    best = F.struct("sse", "knot")  # the lowest of equal fits
    b = s.agg(F.min_by("knot", best).alias("knot"), F.min_by("slope", best).alias("slope"))
    return b.select(F.round(F.col("knot") + F.lit(3.3e-9), 6).alias("knot"),
                    F.round(F.col("slope") + F.lit(3.3e-7), 4).alias("slope"))


@query("binned_response", f"""
SELECT bin, CAST(h % 24 AS INTEGER) AS hour, {R('avg(demand)')} AS mean, count(demand) AS n FROM (
  SELECT CAST(greatest(least(ceil((o.temperature - 0) / 10.0) - 1, 20), -1) AS INTEGER) AS bin, d.h, d.demand FROM v_total d JOIN v_obs o ON o.h = d.h)
GROUP BY ALL""")
def binned_response(spark, sf):
    both = I.demand_total(spark, sf).join(I.weather_obs(spark, sf), "h").withColumn("hour", hour_of_day("h"))
    return out(X.binned(both, "temperature", "demand", 0, 10, 20, ["hour"]))


def drivers(spark, sf):
    """day, y, level, rel, daily weather and calendar: the daily table of the driver analyses."""
    d = I.demand_total(spark, sf).groupBy(day_of_hour("h").alias("day")).agg(F.avg("demand").alias("y"))
    lvl = X.local_level(d, []).withColumn("rel", F.col("y") / F.col("level"))
    obs = I.weather_obs(spark, sf).groupBy(day_of_hour("h").alias("day")).agg(
        F.avg("temperature").alias("tmean"), F.max("temperature").alias("tmax"), F.sum("rain").alias("rain"),
        F.avg("humidity").alias("hum"))
    return lvl.join(obs, "day", "left").join(F.broadcast(I.calendar(spark, sf).drop("date")), "day", "left")


VARS = ["rel", "tmean", "tmax", "rain", "hum"]
CELLS = [(a, b) for i, a in enumerate(VARS) for b in VARS[i:]]


@query("weather_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})')} AS r FROM v_dd" for a, b in CELLS))
def weather_corr_matrix(spark, sf):
    return out(X.correlations(drivers(spark, sf), VARS))


@query("thermal_inertia", f"""
WITH t AS (SELECT day, rel, tmean - CASE WHEN count(tmean) OVER w >= 14 THEN avg(tmean) OVER w END AS anom FROM v_dd
  WINDOW w AS (ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING))
SELECT CAST(k AS INTEGER) AS lag_days, {R('corr(a.rel, b.anom)')} AS r
FROM (SELECT unnest([0, 1, 2, 3]) AS k), t a JOIN t b ON true WHERE b.day = a.day - k GROUP BY k""")
def thermal_inertia(spark, sf):
    d = drivers(spark, sf).select("day", "rel", "tmean")
    lvl = series.centred_mean(d, [], "day", "tmean", 28, 14, "t_level")
    a = lvl.select("day", "rel", (F.col("tmean") - F.col("t_level")).alias("anom"))
    frames = {f"l{k}": (-k, -k, lambda w: F.max("anom").over(w)) for k in range(4)}
    w = series.banded(a, [], "day", frames, DAY_CHUNK)
    long = w.selectExpr("rel", "stack(4, 0, l0, 1, l1, 2, l2, 3, l3) as (lag_days, anom)")
    return out(long.groupBy("lag_days").agg(F.corr("rel", "anom").alias("r")))


@query("rain_effect", f"""
SELECT rain > 100 AS rainy, {R('avg(rel)')} AS rel, count(*) AS days FROM v_dd
WHERE rain IS NOT NULL AND day NOT IN (SELECT day FROM v_cal WHERE event_type IN ('weather', 'operational')) GROUP BY ALL""")
def rain_effect(spark, sf):
    # the "rain" of the test data is in other units: 100 a day plays the 1 mm threshold
    odd = I.calendar(spark, sf).where(F.col("event_type").isin("weather", "operational")).select("day")
    d = drivers(spark, sf).where(F.col("rain").isNotNull()).join(odd, "day", "left_anti")
    return out(d.groupBy((F.col("rain") > 100).alias("rainy")).agg(F.avg("rel").alias("rel"), F.count("*").alias("days")))


@query("forecast_quality", f"""
SELECT CAST(p.h - p.issued_h AS INTEGER) AS lead_h, count(*) AS n, {R('avg(p.temperature - o.temperature)')} AS bias,
  {R('avg(abs(p.temperature - o.temperature))')} AS mae, {R('sqrt(avg((p.temperature - o.temperature) ** 2))')} AS rmse,
  {R('avg(abs(p.humidity - o.humidity))')} AS hum_mae FROM v_pick p JOIN v_obs o ON o.h = p.h GROUP BY ALL""")
def forecast_quality(spark, sf):
    pick = vintages.day_ahead_vintage(I.vintages(spark, sf), [], ["temperature", "humidity"], ["row_id"])
    o = I.weather_obs(spark, sf).select("h", F.col("temperature").alias("t"), F.col("humidity").alias("u"))
    e = F.col("temperature") - F.col("t")
    return out(pick.join(o, "h").groupBy(vintages.lead_hours().alias("lead_h")).agg(
        F.count("*").alias("n"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(F.col("humidity") - F.col("u"))).alias("hum_mae")))


LDD = """ldd AS (SELECT l.day, l.y / l.level AS rel, c.is_public_holiday AS hol, c.is_ramadan AS ram, c.holiday_name, c.ramadan_day,
  c.is_school_break AS school, (l.day + 3) % 7 AS dow, month(c.date) AS month FROM v_llevel l JOIN v_lcal c ON c.day = l.day
  WHERE l.level IS NOT NULL)"""


def long_days(spark, sf):
    """day, rel, calendar facts, dow, month of the long daily series."""
    d = X.local_level(I.daily_long(spark, sf), []).where(F.col("level").isNotNull())
    cal = I.long_calendar(spark, sf)
    return (d.withColumn("rel", F.col("y") / F.col("level")).join(F.broadcast(cal), "day")
            .withColumn("dow", F.pmod(F.col("day") + 3, F.lit(7))).withColumn("month", F.month("date")))


@query("holiday_effect", f"""
WITH {LDD}, b AS (SELECT avg(rel) AS wk FROM ldd WHERE NOT hol AND NOT ram AND dow < 5), n AS (SELECT avg(rel) AS nm FROM ldd WHERE NOT hol AND NOT ram)
SELECT holiday_name AS item, {R('(avg(rel) / any_value(wk) - 1) * 100')} AS effect_pct, count(*) AS days FROM ldd, b WHERE hol GROUP BY ALL
UNION ALL SELECT 'day before', {R('(avg(a.rel) / any_value(nm) - 1) * 100')}, count(*) FROM ldd a JOIN v_lcal c ON c.day = a.day + 1 AND c.is_public_holiday, n
  WHERE NOT a.hol
UNION ALL SELECT 'day after', {R('(avg(a.rel) / any_value(nm) - 1) * 100')}, count(*) FROM ldd a JOIN v_lcal c ON c.day = a.day - 1 AND c.is_public_holiday, n
  WHERE NOT a.hol""")
def holiday_effect(spark, sf):
    from flowgrid.operators.features import calendar_table

    d = long_days(spark, sf)
    marks = calendar_table(I.long_calendar(spark, sf)).select("day", "day_before_holiday", "day_after_holiday")
    d = d.join(F.broadcast(marks), "day")
    normal = ~F.col("is_public_holiday") & ~F.col("is_ramadan")
    base = d.agg(F.avg(F.when(normal & (F.col("dow") < 5), F.col("rel"))).alias("_wk"),
                 F.avg(F.when(normal, F.col("rel"))).alias("_nm"))
    hol = F.col("is_public_holiday")
    item = F.filter(F.array(F.when(hol, F.col("holiday_name")),
                            F.when(~hol & (F.col("day_before_holiday") == 1), "day before"),
                            F.when(~hol & (F.col("day_after_holiday") == 1), "day after")), lambda x: x.isNotNull())
    per = d.withColumn("item", F.explode(item)).groupBy("item").agg(F.avg("rel").alias("_m"), F.count("*").alias("days"))
    ref = F.when(F.col("item").isin("day before", "day after"), F.col("_nm")).otherwise(F.col("_wk"))
    return out(series.attach(per, base, []).select("item", ((F.col("_m") / ref - 1) * 100).alias("effect_pct"), "days"))


@query("period_effect", f"""
WITH {LDD} SELECT 'ramadan' AS item, {R('(avg(rel) FILTER (ram) / avg(rel) FILTER (NOT ram) - 1) * 100')} AS effect_pct
  FROM ldd WHERE month IN (2, 3, 4) AND NOT hol
UNION ALL SELECT 'school break', {R('(avg(rel) FILTER (school) / avg(rel) FILTER (NOT school) - 1) * 100')} FROM ldd
  WHERE month IN (6, 7, 8, 9) AND NOT hol
UNION ALL SELECT 'week ' || ((ramadan_day - 1) // 7 + 1), {R('(avg(rel) - 1) * 100')} FROM ldd WHERE ram AND NOT hol
  GROUP BY (ramadan_day - 1) // 7 + 1""")
def period_effect(spark, sf):
    d = long_days(spark, sf).where(~F.col("is_public_holiday"))
    rel, m = F.col("rel"), F.col("month")

    def effect(cond):
        return (F.avg(F.when(cond, rel)) / F.avg(F.when(~cond, rel)) - 1) * 100

    a = d.where(m.isin(2, 3, 4)).agg(effect(F.col("is_ramadan")).alias("effect_pct")).select(
        F.lit("ramadan").alias("item"), "effect_pct")
    b = d.where(m.isin(6, 7, 8, 9)).agg(effect(F.col("is_school_break")).alias("effect_pct")).select(
        F.lit("school break").alias("item"), "effect_pct")
    week = (F.floor((F.col("ramadan_day") - 1) / 7) + 1).cast("string")
    c = d.where("is_ramadan").groupBy(F.concat(F.lit("week "), week).alias("item")).agg(
        ((F.avg("rel") - 1) * 100).alias("effect_pct"))
    return out(a.unionByName(b).unionByName(c))


@query("period_by_hour", f"""
SELECT r.hour, {R('(avg(r.rel) FILTER (c.is_ramadan) / avg(r.rel) FILTER (NOT c.is_ramadan) - 1) * 100')} AS effect_pct
FROM v_rel r JOIN v_cal c ON c.day = r.day WHERE NOT c.is_public_holiday GROUP BY r.hour""")
def period_by_hour(spark, sf):
    cal = I.calendar(spark, sf).where(~F.col("is_public_holiday")).select("day", "is_ramadan")
    r = X.relative(I.demand(spark, sf), ["series"]).join(F.broadcast(cal), "day")
    rel, ram = F.col("rel"), F.col("is_ramadan")
    return out(r.groupBy("hour").agg(
        ((F.avg(F.when(ram, rel)) / F.avg(F.when(~ram, rel)) - 1) * 100).alias("effect_pct")))


@query("event_study", f"""
WITH e AS (SELECT *, CASE WHEN event_name = lag(event_name) OVER w AND day - lag(day) OVER w = 1 THEN 0 ELSE 1 END AS brk
  FROM v_lcal WHERE event_type IS NOT NULL WINDOW w AS (ORDER BY day)),
b AS (SELECT min(event_name) AS event, min(day) AS first_day FROM (SELECT *, sum(brk) OVER (ORDER BY day) AS run FROM e) GROUP BY run),
o AS (SELECT unnest(generate_series(-3, 3)) AS k)
SELECT b.event, CAST(o.k AS INTEGER) AS offset_days, {R('(avg(l.y / l.level) - 1) * 100')} AS deviation_pct, count(*) AS days
FROM b, o JOIN v_llevel l ON true WHERE l.day = b.first_day + o.k AND l.level IS NOT NULL GROUP BY ALL""")
def event_study(spark, sf):
    blocks = X.event_blocks(I.long_calendar(spark, sf)).select("event", "first_day")
    around = blocks.select("event", "first_day", F.explode(F.sequence(F.lit(-3), F.lit(3))).alias("offset_days"))
    lvl = X.local_level(I.daily_long(spark, sf), []).where(F.col("level").isNotNull())
    j = around.withColumn("day", F.col("first_day") + F.col("offset_days")).join(lvl, "day")
    return out(j.groupBy("event", "offset_days").agg(
        ((F.avg(F.col("y") / F.col("level")) - 1) * 100).alias("deviation_pct"), F.count("*").alias("days")))


@query("residual_anomalies", f"""
WITH t AS (SELECT day, y, CASE WHEN count(y) OVER w >= 7 THEN avg(y) OVER w END AS trend FROM v_daily
  WINDOW w AS (ORDER BY day RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s AS (SELECT *, y - trend - avg(y - trend) OVER (PARTITION BY (day + 3) % 7) AS rem FROM t WHERE trend IS NOT NULL)
SELECT c.date, {R('s.rem / s.trend * 100')} AS residual_pct, {DAY_TYPE.replace('is_', 'c.is_')} AS day_type, c.event_name
FROM (SELECT * FROM s ORDER BY abs(rem / trend) DESC, day LIMIT 15) s JOIN v_lcal c ON c.day = s.day""")
def residual_anomalies(spark, sf):
    t = series.centred_mean(I.daily_long(spark, sf), [], "day", "y", 7, None, "trend").where(F.col("trend").isNotNull())
    t = t.withColumn("_d", F.col("y") - F.col("trend")).withColumn("_w", F.pmod(F.col("day") + 3, F.lit(7)))
    weekly = t.groupBy("_w").agg(F.avg("_d").alias("weekly"))
    r = t.join(F.broadcast(weekly), "_w").select(
        "day", ((F.col("_d") - F.col("weekly")) / F.col("trend") * 100).alias("residual_pct"))
    top = r.orderBy(F.abs("residual_pct").desc(), "day").limit(15)
    cal = I.long_calendar(spark, sf).select("day", X.day_type().alias("day_type"), "event_name")
    return out(top.join(cal, "day"))


@query("distribution_summary", f"""
SELECT CAST(year({DT('day')}) AS INTEGER) AS year, count(y) AS n, {R('avg(y)', 2)} AS mean, {R('stddev_samp(y)', 2)} AS std, {R('min(y)', 2)} AS min,
  {R('max(y)', 2)} AS max, {R('skewness(y)', 4)} AS skew, {R('stddev_samp(y) / avg(y) * 100', 4)} AS cv_pct FROM v_daily GROUP BY ALL""")
def distribution_summary(spark, sf):
    d = I.daily_long(spark, sf).withColumn("year", F.year(day_date("day")))
    s = X.describe(d, ["year"], "y")
    return out(s.drop("skew", "cv_pct"), 2).join(out(s.select("year", "skew", "cv_pct"), 4), "year")


@query("growth_split", f"""
WITH s AS (SELECT day, CASE WHEN count(y) OVER w >= 28 THEN avg(y) OVER w END AS level FROM v_daily
  WINDOW w AS (ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING))
SELECT {DT('a.day')} < DATE '1998-07-01' AS before, {R('avg((a.level / b.level - 1) * 100)')} AS yoy_pct, count(*) AS days
FROM s a JOIN s b ON b.day = a.day - 364 WHERE a.level IS NOT NULL AND b.level IS NOT NULL GROUP BY ALL""")
def growth_split(spark, sf):
    g = X.yoy(I.daily_long(spark, sf), []).where(F.col("yoy_pct").isNotNull())
    before = (day_date("day") < F.lit("1998-07-01").cast("date")).alias("before")
    return out(g.groupBy(before).agg(F.avg("yoy_pct").alias("yoy_pct"), F.count("*").alias("days")))
