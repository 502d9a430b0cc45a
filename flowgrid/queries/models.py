"""Training, scoring (inventory K), pipeline runs and streaming (N)."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgrid.config import Decisions, Project, Quality, Training
from flowgrid.functions.scalars import above
from flowgrid.functions.timefns import day_date, day_of_hour, hour_of_day, hour_pos, hour_ts, weekday_of
from flowgrid.operators import decide as D
from flowgrid.operators import evaluate as E
from flowgrid.operators import explore as X
from flowgrid.operators import features as FE
from flowgrid.operators import models as M
from flowgrid.operators import series, vintages
from flowgrid.operators.series import DAY_CHUNK
from flowgrid.plans import pipeline, training
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.queries.features import LAG_FROM, TARGETS, built, targets
from flowgrid.sources import inputs as I
from flowgrid.sources import tables as T
from flowgrid.session import shared_folder


def frame(spark, sf):
    """Labelled feature rows with full lag history, stored once as the feature table of this run."""
    path = f"{shared_folder(spark, 'features')}/train"
    rows = FE.training_frame(built(spark, sf), I.demand(spark, sf), ["series"]).withColumnRenamed("demand", "y")
    T.overwrite(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("model_seasonal_naive", f"""WITH {TARGETS}, m AS (SELECT avg(demand) AS m FROM v_demand)
SELECT t.series, {TS('t.h')} AS ts, {R('coalesce(l168.demand, (l168.demand + l336.demand + l504.demand) / 3, m.m)')} AS naive_168,
  {R('coalesce(l48.demand, (l168.demand + l336.demand + l504.demand) / 3, m.m)')} AS naive_48,
  {R('coalesce((l168.demand + l336.demand + l504.demand) / 3, l168.demand, m.m)')} AS mean_3w FROM {LAG_FROM}, m""")
def model_seasonal_naive(spark, sf):
    d = I.demand(spark, sf)
    f = series.attach(FE.level_features(targets(spark, sf), d, ["series"]), d.agg(F.avg("demand").alias("_m")), [])
    return out(f.select(
        "series", "h", M.seasonal_naive(default=F.col("_m")).alias("naive_168"),
        M.seasonal_naive("lag_48h", default=F.col("_m")).alias("naive_48"),
        M.seasonal_naive("same_hour_mean_3w", "lag_168h", F.col("_m")).alias("mean_3w")))


def _fit_predict(spark, sf, family, **kw):
    data = frame(spark, sf)
    model = M.fit(family, data, ["series"], **kw)
    return out(model.predict(data).select("series", "h", "y", "pred"))


@query("model_ridge_fourier")
def model_ridge_fourier(spark, sf):
    return _fit_predict(spark, sf, "ridge_fourier")


@query("model_ridge_interactions")
def model_ridge_interactions(spark, sf):
    return _fit_predict(spark, sf, "ridge_interactions")


@query("model_gbt")
def model_gbt(spark, sf):
    return _fit_predict(spark, sf, "gbt", gbt=Training().gbt)


@query("model_random_forest")
def model_random_forest(spark, sf):
    return _fit_predict(spark, sf, "random_forest_trend", gbt={"maxDepth": 5})


def _orthogonal_sql(target: str, others: list[str]) -> str:
    """CTEs that take ``others`` out of ``target`` one after the other; q is what is left of the target."""
    steps, names = [], [f"v{i}" for i in range(len(others))] + ["q"]
    steps.append(f"g0 AS MATERIALIZED (SELECT series, ly, {', '.join(f'{c} AS v{i}' for i, c in enumerate(others))}, "
                 f"{target} AS q FROM terms)")
    for i in range(len(others)):
        keep = ", ".join(names[:i + 1])
        rest = ", ".join(f"{n} - v{i} * sum({n} * v{i}) OVER (PARTITION BY series) / "
                         f"sum(v{i} * v{i}) OVER (PARTITION BY series) AS {n}" for n in names[i + 1:])
        steps.append(f"g{i + 1} AS MATERIALIZED (SELECT series, ly, {keep}, {rest} FROM g{i})")
    tag = "s" if target == "t" else "i"
    return ", ".join(steps).replace("g", f"{tag}g") + f", {tag}_fit AS (SELECT series, sum(q * ly) / sum(q * q) AS b FROM {tag}g{len(others)} GROUP BY series)"


WAVES = ["sin(2 * pi() * t / 365.25)", "cos(2 * pi() * t / 365.25)", "sin(4 * pi() * t / 365.25)", "cos(4 * pi() * t / 365.25)"]


@query("growth_trend", f"""
WITH terms AS MATERIALIZED (SELECT series, ln(y) AS ly, t, 1.0::DOUBLE AS one, {', '.join(f'{w} AS w{i}' for i, w in enumerate(WAVES))}
  FROM (SELECT series, y, (day - 19723)::DOUBLE AS t FROM v_prio WHERE y > 0)),
{_orthogonal_sql('t', ['one', 'w0', 'w1', 'w2', 'w3'])}, {_orthogonal_sql('one', ['t', 'w0', 'w1', 'w2', 'w3'])}
SELECT s.series, {R('i.b', 4)} AS intercept, {R('s.b * 1000000', 4)} AS slope_ppm, {R('(exp(s.b * 365) - 1) * 100', 4)} AS annual_growth_pct
FROM s_fit s JOIN i_fit i ON i.series = s.series""")
def growth_trend(spark, sf):
    d = I.daily_by_priority(spark, sf).withColumn("t_days", (F.col("day") - 19723).cast("double"))
    g = M.growth_trend(d, ["series"])
    return out(g.select("series", "intercept", (F.col("slope") * 1e6).alias("slope_ppm"),
                        M.annual_growth_pct().alias("annual_growth_pct")), 4)


@query("growth_trend_short", f"""
SELECT series, {R('avg(ln(y))')} AS intercept, 0.0::DOUBLE AS slope FROM v_dmean WHERE y > 0 GROUP BY series""")
def growth_trend_short(spark, sf):
    d = FE.trend_feature(I.demand(spark, sf)).withColumnRenamed("demand", "y")
    return out(M.growth_trend(d, ["series"]))


@query("trend_normalise", f"""
WITH g AS (SELECT series, exp(avg(ln(y))) AS trend FROM v_dmean WHERE y > 0 GROUP BY series)
SELECT d.series, {TS('d.h')} AS ts, {R('d.demand / g.trend')} AS y, {R('a.demand / g.trend')} AS lag_168h, {R('g.trend')} AS trend
FROM v_demand d JOIN g ON g.series = d.series LEFT JOIN v_demand a ON a.series = d.series AND a.h = d.h - 168""")
def trend_normalise(spark, sf):
    d = FE.trend_feature(I.demand(spark, sf)).withColumnRenamed("demand", "y")
    x = series.lag_join(d, d, ["series"], "h", "y", {"lag_168h": 168})
    z = M.normalise(x, M.growth_trend(d, ["series"]), ["series"])
    return out(z.select("series", "h", "y", "lag_168h", "trend"))


@query("model_blend", f"SELECT series, {TS('h')} AS ts, y, {R('(naive_168 + mean_3w) / 2')} AS pred FROM v_wide")
def model_blend(spark, sf):
    return out(E.ensemble(I.predictions(spark, sf), ["series", "h"], ["naive_168", "mean_3w"]))


@query("model_factory")
def model_factory(spark, sf):
    data = frame(spark, sf)
    parts = None
    for family, fitted in M.fit_all(M.FAMILIES, data, ["series"], gbt=Training().gbt).items():
        m = fitted.predict(data).select(F.lit(family).alias("model"), "y", "pred")
        parts = m if parts is None else parts.unionByName(m)
    return out(E.metrics(parts, ["model"]))


@query("train_select")
def train_select(spark, sf):
    """All candidates with the configured rounds, rules and ceiling; nine labelled days leave two for the holdout."""
    p = Project(root=shared_folder(spark, "train"), series_keys=("series",), training=Training(holdout_days=2))
    training.select(spark, p, frame(spark, sf), "query")
    return spark.read.parquet(p.path("monitoring.model_selection")).select(
        "family", "mape", "wape", "rmse", "bias_pct", "peak_mape", "selected", "promoted", "decision")


@query("champion_challenger", f"""
WITH u AS (SELECT * FROM v_pred WHERE h > (SELECT max(h) - 192 FROM v_demand)),
s AS (SELECT series, avg(CASE WHEN model = 'mean_3w' AND y > 0 THEN abs(pred - y) / y * 100 END) AS challenger,
  avg(CASE WHEN model = 'naive_168' AND y > 0 THEN abs(pred - y) / y * 100 END) AS champion, count(DISTINCT h // 24) AS days FROM u GROUP BY series)
SELECT series, days, {R('challenger')} AS challenger, {R('champion')} AS champion,
  days >= 7 AND (champion - challenger) / champion * 100 >= 1 AS promote FROM s""")
def champion_challenger(spark, sf):
    p = series.attach(I.predictions(spark, sf), I.demand(spark, sf).agg((F.max("h") - 192).alias("through")), [])
    fair = D.fair_hours(p, F.col("through"), ["series"])
    unseen = p.where(F.col("h") > F.col("through"))
    ape = F.when(F.col("y") > 0, F.abs(E.error()) / F.col("y") * 100)
    s = unseen.groupBy("series").agg(F.avg(F.when(F.col("model") == "mean_3w", ape)).alias("challenger"),
                                     F.avg(F.when(F.col("model") == "naive_168", ape)).alias("champion"))
    rule = D.promote_column(F.col("challenger"), F.col("champion"), Decisions(max_acceptable_mape=1e9))
    return out(s.join(fair, "series").select("series", "days", "challenger", "champion",
                                             (F.col("comparable") & rule).alias("promote")))


@query("champion_challenger_fitted")
def champion_challenger_fitted(spark, sf):
    """Two training runs with the configured rules: the naive forecast becomes champion if the rules allow it, then fitted
    ridges challenge it on the hours that it has not seen."""
    p = Project(root=shared_folder(spark, "challenge"), series_keys=("series",), training=Training(candidates=("seasonal_naive_168",), holdout_days=7))
    data = frame(spark, sf)
    last = data.agg(F.max("h")).first()[0]
    training.select(spark, p, data.where(F.col("h") <= last - 7 * 24), "first")
    rivals = replace(p, training=Training(candidates=("ridge_fourier", "ridge_interactions"), holdout_days=7))
    training.select(spark, rivals, data, "second")
    return spark.read.parquet(p.path("monitoring.model_selection")).select(
        "trigger", "family", "mape", "selected", "registered_version", "champion_version_before", "champion_mape_on_holdout", "promoted", "decision")


@query("score_forecast", f"""
WITH r AS (SELECT max(h // 24) + 1 AS a, max(h // 24) + 2 AS b FROM v_demand),
t AS (SELECT series, unnest(generate_series(a * 24, b * 24 + 23)) AS h FROM (SELECT DISTINCT series FROM v_demand), r)
SELECT t.series, {TS('t.h')} AS target_ts, {R('greatest(coalesce(a.demand, (a.demand + b.demand + c.demand) / 3, m.m), 0)', 3)} AS predicted_m3, {TS('(t.h // 24 - 1) * 24 + 5')} AS issued_at
FROM t LEFT JOIN v_demand a ON a.series = t.series AND a.h = t.h - 168 LEFT JOIN v_demand b ON b.series = t.series AND b.h = t.h - 336
LEFT JOIN v_demand c ON c.series = t.series AND c.h = t.h - 504, (SELECT avg(demand) AS m FROM v_demand) m""")
def score_forecast(spark, sf):
    d = I.demand(spark, sf)
    span = d.agg(((F.max(day_of_hour("h")) + 1) * 24).alias("a"))
    tgt = series.attach(d.select("series").distinct(), span, []).select(
        "series", F.explode(F.sequence(F.col("a"), F.col("a") + 47)).alias("h"))
    model = M.fit("seasonal_naive_168", d, ["series"], "demand")
    scored = model.predict(FE.level_features(tgt, d, ["series"]))
    return out(pipeline.forecast_rows(scored, ["series"], digits=None), 3)


@query("feature_importance")
def feature_importance(spark, sf):
    m = M.fit("gbt", frame(spark, sf), ["series"], gbt=Training().gbt)
    return spark.createDataFrame(M.importance(m.parts["gbt"])[:20], "feature string, gain double")


@query("topk_importance")
def topk_importance(spark, sf):
    m = M.fit("random_forest_trend", frame(spark, sf), ["series"], gbt={"maxDepth": 5})
    return spark.createDataFrame(M.importance(m.parts["forest"])[:15], "feature string, gain double")


@query("model_registry", """
SELECT alias, version, family, n FROM (SELECT 'champion' AS alias, 2 AS version, 'seasonal_naive_48' AS family
  UNION ALL SELECT 'challenger', 1, 'seasonal_naive_168'), (SELECT count(*) AS n FROM v_demand)""")
def model_registry(spark, sf):
    from flowgrid.plans.registry import Registry

    d = I.demand(spark, sf)
    p = Project(root=shared_folder(spark, "registry"), series_keys=("series",))
    reg = Registry(spark, p)
    for family in ("seasonal_naive_168", "seasonal_naive_48"):
        v = reg.register(M.fit(family, d, ["series"], "demand"), {"trigger": "query"})
        reg.set_alias("champion", v)
    reg.set_alias("challenger", 1)
    rows = [(a, reg.version(a)["version"], reg.version(a)["family"]) for a in ("champion", "challenger")]
    names = spark.createDataFrame(rows, "alias string, version int, family string")
    return series.attach(names, d.agg(F.count("*").alias("n")), [])


@query("permutation_importance")
def permutation_importance(spark, sf):
    data = frame(spark, sf)
    m = M.fit("ridge_fourier", data, ["series"])
    groups = M.importance_groups()
    res = M.permutation_importance(m, data, ["series", "h"], groups)
    return spark.createDataFrame(res, "feature_group string, mape_rise double")


@query("permute_group", f"""
SELECT series, count(*) AS n, {R('sum(y)')} AS y_sum, (SELECT {R('sum(y)')} FROM v_wide) AS shuffled_sum, true AS moved, true AS mixed
FROM v_wide GROUP BY series""")
def permute_group(spark, sf):
    """Moved: nearly all rows have another row's value. Mixed: what they have is uncorrelated with their own."""
    w = I.wide_predictions(spark, sf).select("series", "h", "y", F.col("y").alias("x"))
    p = M.permute_group(w, ["series", "h"], ["x"], 7)
    total = p.agg(F.sum("x").alias("shuffled_sum"), (F.avg((F.col("x") != F.col("y")).cast("double")) > 0.9).alias("moved"),
                  (F.abs(F.corr("x", "y")) < 4 / F.sqrt(F.count("*"))).alias("mixed"))
    return out(series.attach(p.groupBy("series").agg(F.count("*").alias("n"), F.sum("y").alias("y_sum")), total, []))


@query("topdown_disaggregate", f"""
WITH p AS MATERIALIZED (SELECT t.h // 24 AS day, t.h % 24 AS hour, t.demand / m.y AS r FROM v_total t JOIN v_tot m ON m.day = t.h // 24
  QUALIFY count(*) OVER (PARTITION BY t.h // 24) = 24),
d AS MATERIALIZED (SELECT DISTINCT p.day, c.is_ramadan AS a, (c.is_weekend OR c.is_public_holiday) AS b FROM p JOIN v_cal c ON c.day = p.day),
s AS MATERIALIZED (SELECT t.day, x.day AS src FROM d t JOIN d x ON x.day <= t.day - 2 AND x.a = t.a AND x.b = t.b
  QUALIFY row_number() OVER (PARTITION BY t.day ORDER BY x.day DESC) <= 8),
n AS MATERIALIZED (SELECT t.day, x.day AS src FROM d t JOIN d x ON x.day <= t.day - 2
  QUALIFY row_number() OVER (PARTITION BY t.day ORDER BY x.day DESC) <= 8),
k AS MATERIALIZED (SELECT day, src FROM s WHERE day IN (SELECT day FROM s GROUP BY day HAVING count(*) >= 3)
  UNION ALL SELECT day, src FROM n WHERE day NOT IN (SELECT day FROM s GROUP BY day HAVING count(*) >= 3)),
f AS MATERIALIZED (SELECT k.day, p.hour, avg(p.r) AS r FROM k JOIN p ON p.day = k.src GROUP BY ALL)
SELECT {DT('f.day')} AS date, CAST(f.hour AS INTEGER) AS hour, {R('l.y * f.r / avg(f.r) OVER (PARTITION BY f.day)', 4)} AS pred
FROM f JOIN v_tot l ON l.day = f.day - 7""")
def topdown_disaggregate(spark, sf):
    d = I.demand_total(spark, sf).withColumn("day", day_of_hour("h")).withColumn("hour", hour_of_day("h"))
    level = d.groupBy("day").agg(F.avg("demand").alias("mean"), F.count("*").alias("n"))
    off = (F.col("is_weekend") | F.col("is_public_holiday")).cast("string")
    cal = I.calendar(spark, sf).select("day", F.concat_ws("-", F.col("is_ramadan").cast("string"), off).alias("klass"))
    full = level.where(F.col("n") == 24).join(F.broadcast(cal), "day")
    past = X.class_history(full, [], "klass")
    shape = d.join(full.select("day", "mean"), "day").select(
        F.col("day").alias("src_day"), "hour", (F.col("demand") / F.col("mean")).alias("r"))
    prof = past.join(shape, "src_day").groupBy("day", "hour").agg(F.avg("r").alias("r"))
    prof = prof.withColumn("_m", F.avg("r").over(Window.partitionBy("day")))
    ahead = vintages.shift_days(level.select("day", "mean"), 7, {"mean": "level"})
    return out(prof.join(ahead, "day").select("day", "hour", (F.col("level") * F.col("r") / F.col("_m")).alias("pred")), 4)


@query("daily_exog", f"""
WITH f AS (SELECT h // 24 AS day, avg(temperature) AS t FROM v_vint GROUP BY ALL),
j AS (SELECT t.day, CASE WHEN f.t IS NOT NULL THEN greatest(f.t - 24.4, 0) END AS cdd, (c.is_weekend OR c.is_public_holiday) AS off,
  (t.day + 3) % 7 = 4 AS fri, (t.day + 3) % 7 = 5 AS sat, coalesce(c.holiday_name LIKE '%Eid%', false) AS eid, c.is_ramadan AS ram,
  coalesce(c.event_type IN ('weather', 'operational'), false) AS flood
  FROM v_tot t LEFT JOIN f ON f.day = t.day LEFT JOIN v_cal c ON c.day = t.day)
SELECT {DT('day')} AS date, {R('last_value(cdd IGNORE NULLS) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING)')} AS cdd,
  CAST(off AS INTEGER) AS dayoff, CAST(fri AS INTEGER) AS fri, CAST(sat AS INTEGER) AS sat, CAST(eid AS INTEGER) AS eid,
  CAST(ram AS INTEGER) AS ramadan, CAST(flood AS INTEGER) AS flood FROM j""")
def daily_exog(spark, sf):
    days = I.demand_total(spark, sf).select(day_of_hour("h").alias("day")).distinct()
    mean = vintages.daily_mean(I.vintages(spark, sf), [], "temperature", "t")
    cal = I.calendar(spark, sf).drop("date")
    j = days.join(mean, "day", "left").join(F.broadcast(cal), "day", "left").withColumn("cdd0", above("t", 24.4))
    j = series.carry(j, [], "day", F.col("cdd0").isNotNull(), {"cdd": F.col("cdd0")}, DAY_CHUNK)
    dow = weekday_of("day")
    one = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return out(j.select(
        "day", F.col("prev_cdd").alias("cdd"), one(F.col("is_weekend") | F.col("is_public_holiday")).alias("dayoff"),
        one(dow == 4).alias("fri"), one(dow == 5).alias("sat"), one(F.col("holiday_name").contains("Eid")).alias("eid"),
        one(F.col("is_ramadan")).alias("ramadan"),
        one(F.col("event_type").isin("weather", "operational")).alias("flood")))


# ---- pipeline --------------------------------------------------------------------------------------------------
def _project(spark, name: str, first: date, last: date) -> Project:
    """Limits that fit the test data: sparse hours, spikes above 200, wide temperatures."""
    return Project(root=shared_folder(spark, name), series_keys=("site_id",), history_start=str(first), history_end=str(last),
                   quality=Quality(demand_max=200.0, temperature_min=0.0, temperature_max=1000.0, max_missing_pct=100.0))


@query("run_daily")
def run_daily(spark, sf):
    """A first load of the history up to three days before the end of the data, then a daily run at its last day."""
    feeds = {k: v.drop("row_id") for k, v in I.feeds(spark, sf).items()}
    first, last = (d.date() for d in feeds["consumption"].agg(F.min("timestamp_local"), F.max("timestamp_local")).first())
    nine = lambda back: datetime.combine(last - timedelta(days=back), time(9))
    p = _project(spark, "daily", first, last - timedelta(days=3))
    got = pipeline.run_daily(spark, p, feeds, nine(2), "backfill")
    if got["gate"]:
        from flowgrid.plans.registry import Registry

        data = FE.training_frame(
            spark.read.parquet(p.path("gold.demand_features")).withColumn("h", hour_pos("target_ts")),
            pipeline.silver_inputs(spark, p)["demand"], ["site_id"])
        model = M.fit("seasonal_naive_168", data, ["site_id"], "demand")
        reg = Registry(spark, p)
        reg.set_alias("champion", reg.register(model, {"holdout_mape": "10"}))
        pipeline.forecast(spark, p, "setup")
        pipeline.run_daily(spark, p, feeds, nine(0), "daily")
        pipeline.monitor(spark, p)
    res = spark.read.parquet(p.path("monitoring.dq_results")).select(
        F.lit("gate").alias("step"), F.concat_ws(".", "table_name", "check_name").alias("item"),
        F.col("failed_rows").cast("double").alias("value"))
    log = pipeline.read(spark, p, "gold.demand_forecasts")
    if log is not None:
        res = res.unionByName(log.groupBy("site_id", "p_day").agg(F.sum("predicted_m3").alias("value")).select(
            F.lit("forecast").alias("step"), F.concat_ws(" ", "site_id", "p_day").alias("item"), "value"))
    acc = pipeline.read(spark, p, "monitoring.forecast_accuracy_daily")
    if acc is not None:
        res = res.unionByName(acc.select(F.lit("accuracy").alias("step"), F.concat_ws(" ", "site_id", "p_day").alias("item"),
                                         F.col("mape").alias("value")))
    return res


# ---- streaming -------------------------------------------------------------------------------------------------
def stream_source(spark, sf):
    from flowgrid.streaming import streams

    return streams.source(spark, f"{sf}/events.parquet", I.TABLES["events"])


@query("stream_bronze", """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, '20240131-00000001' AS _batch_id FROM events GROUP BY event_type""")
def stream_bronze(spark, sf):
    from flowgrid.streaming import streams

    root = shared_folder(spark, "bronze")
    for _ in range(2):  # the second run finds nothing new: the checkpoint makes ingestion idempotent
        streams.bronze(stream_source(spark, sf), f"{root}/_cp", f"{root}/events", "20240131-00000001")
    return spark.read.parquet(f"{root}/events").groupBy("event_type", "_batch_id").agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("stream_dedupe", f"SELECT series, {TS('h')} AS ts, max(event_id) AS event_id FROM v_ev GROUP BY ALL")
def stream_dedupe(spark, sf):
    from flowgrid.streaming import streams

    root = shared_folder(spark, "dedupe")
    rows = stream_source(spark, sf).select(F.col("event_type").alias("series"), hour_pos("ts").alias("h"), "event_id",
                                           F.to_date("ts").cast("string").alias("p_day"))
    streams.latest_version(spark, rows, f"{root}/_cp", f"{root}/latest", ["series", "h", "p_day"], ["event_id"], "p_day")
    return out(spark.read.parquet(f"{root}/latest").select("series", "h", "event_id"))


def _in_three(spark, rows, root, by):
    """A stream of three micro-batches that hold the rows for which ``by`` is 0, 1 and 2."""
    from flowgrid.streaming import streams

    for part in range(3):
        rows.where(by == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return streams.source(spark, f"{root}/in", ", ".join(f"{n} {t}" for n, t in rows.dtypes), files_per_batch=1)


@query("stream_newest", f"SELECT series, {TS('h')} AS ts, max(event_id) AS event_id, max(event_id % 3) >= 0 AS changed FROM v_ev GROUP BY ALL")
def stream_newest(spark, sf):
    """Newest version of every key by keyed state, over three micro-batches that split every key between them."""
    from flowgrid.streaming import streams

    root = shared_folder(spark, "newest")
    rows = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("series"), hour_pos("ts").alias("h"), "event_id", "ts")
    stream = _in_three(spark, rows, root, F.col("event_id") % 3)
    streams.run(streams.newest(stream, ["series", "h"], "event_id", "ts", "3650 days"), f"{root}/_cp", f"{root}/log")
    log = spark.read.parquet(f"{root}/log").groupBy("series", "h").agg(F.max("event_id").alias("event_id"), (F.count("*") >= 1).alias("changed"))
    return out(log.select("series", "h", "event_id", "changed"))


@query("stream_runs", f"""
WITH b AS (SELECT series, h, d, CASE WHEN d = lag(d) OVER w AND h - lag(h) OVER w = 1 THEN 0 ELSE 1 END AS brk
  FROM (SELECT series, h, floor(demand / 50) AS d FROM v_demand) WINDOW w AS (PARTITION BY series ORDER BY h)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY h) AS run FROM b)
SELECT series, {TS('min(h)')} AS run_start, count(*) AS hours FROM r GROUP BY series, run HAVING count(*) >= 2""")
def stream_runs(spark, sf):
    """Runs of equal demand classes over three micro-batches in order of time, cut anywhere within a run."""
    from flowgrid.streaming import streams

    root = shared_folder(spark, "runs")
    d = I.demand(spark, sf).select("series", F.col("h").cast("bigint").alias("h"), F.floor(F.col("demand") / 50).cast("double").alias("class"), hour_ts("h").alias("ts"))
    ends = d.agg(F.min("h").alias("_a"), F.max("h").alias("_b"))
    part = F.least(F.floor((F.col("h") - F.col("_a")) * 3 / (F.col("_b") - F.col("_a"))), F.lit(2)).alias("_part")
    d = series.attach(d, ends, []).select("series", "h", "class", "ts", part)
    stream = _in_three(spark, d, root, F.col("_part"))
    streams.run(streams.run_starts(stream, ["series"], "h", "class", "ts"), f"{root}/_cp", f"{root}/out")
    runs = spark.read.parquet(f"{root}/out").groupBy("series", "run_start").agg(F.count("*").alias("hours")).where("hours >= 2")
    return runs.select("series", hour_ts("run_start").alias("run_start"), "hours")


@query("stream_repeats", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def stream_repeats(spark, sf):
    from flowgrid.streaming import streams

    root = shared_folder(spark, "repeats")
    twice = stream_source(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.exact_repeats(twice, ["event_id"], "ts", "2 days")
    streams.run(once, f"{root}/_cp", f"{root}/out")
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_hourly", f"""
SELECT series, {TS('h')} AS ts, CAST(sum(CAST(value AS DECIMAL(28,9))) AS DOUBLE) AS total, count(*) AS n FROM v_ev
GROUP BY series, h HAVING {TS('h + 1')} <= (SELECT date_trunc('second', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def stream_hourly(spark, sf):
    from flowgrid.streaming import streams

    root = shared_folder(spark, "hourly")
    s = stream_source(spark, sf).select(F.col("event_type").alias("series"), "ts", "value")
    streams.run(streams.hourly(s, ["series"], "ts", "value"), f"{root}/_cp", f"{root}/out")
    return spark.read.parquet(f"{root}/out").select("series", "ts", "total", "n")


@query("stream_gate", """
SELECT coalesce(reason, 'clean') AS outcome, count(*) AS n FROM v_tagged GROUP BY ALL""")
def stream_gate(spark, sf):
    """The gate over three micro-batches that split every hour between them."""
    from flowgrid.operators import quality
    from flowgrid.streaming import streams

    root = shared_folder(spark, "gate")
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_type").alias("series"), hour_pos("ts").alias("h"), F.col("event_id").alias("row_id"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("demand"), F.to_date("ts").cast("string").alias("p_day"))
    for part in range(3):
        rows.where(F.col("row_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = streams.source(spark, f"{root}/in", ", ".join(f"{n} {t}" for n, t in rows.dtypes), files_per_batch=1)
    streams.gate(spark, stream, f"{root}/_cp", f"{root}/gated",
                 lambda b: quality.tag(b, ["series", "h"], "row_id", [], ["h", "demand"], "demand", 0.0, 200.0, 3))
    return spark.read.parquet(f"{root}/gated").groupBy(F.coalesce("reason", F.lit("clean")).alias("outcome")).agg(
        F.count("*").alias("n"))


@query("late_corrections", f"""
SELECT series, {DT('h // 24')} AS date, {R('sum(CASE WHEN h // 24 >= (SELECT max(h // 24) - 1 FROM v_demand) THEN demand * 1.5 ELSE demand END)')} AS total
FROM v_demand GROUP BY ALL""")
def late_corrections(spark, sf):
    d = I.demand(spark, sf).withColumn("day", day_of_hour("h"))
    path = f"{shared_folder(spark, 'late')}/daily"
    T.upsert(spark, d.groupBy("series", "day").agg(F.sum("demand").alias("total")), path, ["series", "day"], "day")
    d = series.attach(d, d.agg((F.max("day") - 1).alias("_from")), [])
    replay = d.where(F.col("day") >= F.col("_from")).groupBy("series", "day").agg(F.sum(F.col("demand") * 1.5).alias("total"))
    for _ in range(2):  # a replay changes nothing
        T.upsert(spark, replay, path, ["series", "day"], "day")
    return out(spark.read.parquet(path).select("series", F.col("day").cast("bigint").alias("day"), "total"))
