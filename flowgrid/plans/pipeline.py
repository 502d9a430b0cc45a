"""The daily job: land -> bronze -> quality gate -> silver -> features -> forecast -> monitor.

Only scalars reach the driver (watermarks, plan dates, the verdict, the promotion decision) and the ids of pending
batches. Each step can be run again after a failure. Landing and bronze are partitioned by batch, and a small ledger per
layer names the batches that it holds complete; it is written last. A step works on the batches that the ledger before
it has and its own lacks, so nothing else is read and a job killed between two feeds repeats the whole batch. Silver,
features and accuracy are upserts by key; the forecast log is append-only and resolved on read.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.config import Project
from flowgrid.functions.timefns import day_date, day_of_hour, hour_pos, hour_ts
from flowgrid.operators import decide, evaluate, features, quality
from flowgrid.plans import landing
from flowgrid.plans.registry import Registry
from flowgrid.schemas import FEEDS
from flowgrid.sources import tables as T

ONE_DAY = timedelta(days=1)
EPOCH = date(1970, 1, 1)
ACTIVE_DAYS = 28  # a series with a reading in so many days before the owed ones owes a forecast

# feed -> required columns, ranged column, series-keyed?
RULES = {
    "consumption": (["timestamp_local", "demand_m3h"], "demand_m3h", True),
    "weather_obs": (["timestamp_local", "temperature_c"], "temperature_c", False),
    "weather_fcst": (["forecast_issued_local", "timestamp_local", "forecast_temperature_c"], "forecast_temperature_c",
                     False),
    "calendar": (["date"], None, False),
}


LEDGER = "batch_id string, newest_day int, next_row bigint, ingested_at timestamp"


def read(spark: SparkSession, p: Project, table: str) -> DataFrame | None:
    path = p.path(table)
    return spark.read.parquet(path) if T.exists(spark, path) else None


def ledger(spark: SparkSession, p: Project, layer: str) -> DataFrame:
    """One row per batch that a layer holds complete."""
    path = p.path(f"{layer}.batches")
    return spark.read.schema(LEDGER).parquet(path) if T.exists(spark, path) else spark.createDataFrame([], LEDGER)


def enter(spark: SparkSession, p: Project, layer: str, rows: DataFrame) -> None:
    T.append(rows.select("batch_id", "newest_day", "next_row", "ingested_at").coalesce(1), p.path(f"{layer}.batches"))


def pending(spark: SparkSession, p: Project, before: str, layer: str) -> DataFrame:
    """Ledger rows of the layer before that this layer lacks."""
    return ledger(spark, p, before).join(ledger(spark, p, layer).select("batch_id"), "batch_id", "left_anti")


def of_batches(df: DataFrame | None, ids: list[str]) -> DataFrame | None:
    """The partitions of the given batches."""
    return None if df is None else df.where(F.col("_batch_id").isin(ids))


def scalar(df: DataFrame):
    row = df.first()
    return None if row is None else row[0]


def newest_day(df: DataFrame | None, column: str = "timestamp_local") -> date | None:
    return None if df is None else scalar(df.agg(F.to_date(F.max(column))))


def landed_days(spark: SparkSession, p: Project) -> DataFrame:
    """high_water of the landed batches and of silver, which a refresh may fill without landing anything."""
    marks = ledger(spark, p, "landing").select(F.col("newest_day").alias("high_water"))
    silver = read(spark, p, "silver.consumption")
    if silver is None:
        return marks
    day = F.datediff(F.to_date("p_day"), F.lit("1970-01-01").cast("date"))  # folder names only
    return marks.union(silver.agg(F.max(day).alias("high_water")))


def today_of(spark: SparkSession, p: Project) -> date:
    """The issue day of this environment: the day after its newest reading, even when it lags behind the clock."""
    silver = read(spark, p, "silver.consumption")
    newest = None if silver is None else scalar(silver.agg(F.to_date(F.max("p_day"))))
    if newest is None:
        raise RuntimeError("silver is empty: run landing and the gate first")
    return newest + ONE_DAY


def land(spark: SparkSession, p: Project, feeds: dict[str, DataFrame], mode: str, now_local: datetime,
         fault: str = "none") -> str:
    """Append every missing complete day of the four feeds as one batch; returns its id or why there is none."""
    days = lambda d: (d - EPOCH).days
    history = (days(date.fromisoformat(p.history_start)), days(date.fromisoformat(p.history_end))) if mode == "backfill" else None
    due = landing.due_days(landed_days(spark, p), F.lit(days(now_local.date())), history).first()
    if due["first_day"] is None:
        if mode != "backfill" and due["high_water"] is None:
            raise RuntimeError("nothing has landed: run the setup backfill first")
        return "skipped" if mode == "backfill" else "up_to_date"
    start, end = (EPOCH + timedelta(days=due[c]) for c in ("first_day", "last_day"))
    batch = T.source_window(feeds, start, end, now_local)
    for name, df in batch.items():
        if fault != "none" and name != "calendar":
            h = df.withColumn("_h", hour_pos("timestamp_local"))
            batch[name] = quality.inject_fault(h, fault, name, "_h").drop("_h")
    if batch["consumption"].isEmpty():
        raise RuntimeError(f"the source returned no consumption for {start}..{end}")
    batch_id = T.new_batch_id(end)
    first_row = scalar(ledger(spark, p, "landing").agg(F.coalesce(F.max("next_row"), F.lit(0))))
    next_row = first_row
    for name, df in batch.items():
        stamped = T.with_lineage(df, batch_id).withColumn("_row_id", first_row + F.monotonically_increasing_id())
        if name != "consumption" and stamped.isEmpty():
            continue
        T.append(stamped, p.path(f"landing.{name}"), ["_batch_id"])
        stored = of_batches(read(spark, p, f"landing.{name}"), [batch_id])
        top = None if stored is None else scalar(stored.agg(F.max("_row_id")))
        next_row = next_row if top is None else max(next_row, top + 1)
    enter(spark, p, "landing", spark.createDataFrame([(batch_id, (end - EPOCH).days, next_row)], "batch_id string, newest_day int, "
                                                     "next_row bigint").withColumn("ingested_at", F.current_timestamp()))
    return batch_id


def ingest_bronze(spark: SparkSession, p: Project) -> None:
    """Copy landing batches that bronze does not hold; one ingestion time for the whole run."""
    new = pending(spark, p, "landing", "bronze").withColumn("ingested_at", F.lit(scalar(spark.sql("SELECT current_timestamp()"))))
    new = spark.createDataFrame(new.collect(), LEDGER)  # batches since the last run, one a day
    ids = [r["batch_id"] for r in new.collect()]
    if not ids:
        return
    for name in FEEDS:
        src = of_batches(read(spark, p, f"landing.{name}"), ids)
        if src is not None and not src.isEmpty():
            stamp = F.lit(new.first()["ingested_at"])
            T.replace_partitions(src.withColumn("_ingested_at", stamp), p.path(f"bronze.{name}"), "_batch_id")
    enter(spark, p, "bronze", new)


def _tag(df: DataFrame, name: str, p: Project) -> DataFrame:
    required, ranged, keyed = RULES[name]
    q = p.quality
    lo, hi = (q.demand_min, q.demand_max) if name == "consumption" else (q.temperature_min, q.temperature_max)
    series = list(p.series_keys) if keyed else []
    if name == "calendar":
        return quality.tag(df, ["date"], "_row_id", ["_ingested_at"], required)
    df = df.withColumn("_h", hour_pos("timestamp_local"))
    key = [*series, *(["forecast_issued_local"] if name == "weather_fcst" else []), "_h"]
    return quality.tag(df, key, "_row_id", ["_ingested_at"], required, ranged, lo, hi,
                       q.stuck_hours if name == "consumption" else 0)


def _record(spark: SparkSession, p: Project, run_id: str, results: DataFrame, bad: DataFrame | None) -> None:
    T.append(results.select("*", F.lit(run_id).alias("run_id"), F.lit(p.env).alias("env"),
                            F.current_timestamp().alias("checked_at")), p.path("monitoring.dq_results"))
    if bad is not None:
        T.append(bad.select("*", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("detected_at")),
                 p.path("monitoring.dq_quarantine"))


SILVER_KEYS = {"consumption": ["timestamp_local"], "weather_obs": ["timestamp_local"],
               "weather_fcst": ["forecast_issued_local", "timestamp_local"], "calendar": ["date"]}


def quality_gate(spark: SparkSession, p: Project, run_id: str, today: date, allow_no_new: bool = False) -> bool:
    """Validate everything in bronze newer than silver. Silver is written only when every blocking check passes;
    results and quarantine are recorded either way, and a failed batch is validated again with the next one."""
    due = pending(spark, p, "bronze", "silver").collect()  # batches since the last passed gate
    ids = [r["batch_id"] for r in due]
    new = {name: of_batches(read(spark, p, f"bronze.{name}"), ids) for name in FEEDS}
    cons = new["consumption"]
    if cons is None or cons.isEmpty():
        silver = read(spark, p, "silver.consumption")
        latest = None if silver is None else scalar(silver.agg(F.to_date(F.max("p_day"))))
        days = F.lit(None if latest is None else (latest - EPOCH).days).cast("int")
        ok = scalar(spark.range(1).select(quality.freshness(days, F.lit((today - EPOCH).days), allow_no_new)))
        row = spark.createDataFrame([("freshness", "consumption", "error", ok, 0, f"nothing to validate; silver ends on {latest}")],
                                    "check_name string, table_name string, severity string, passed boolean, "
                                    "failed_rows bigint, detail string")
        _record(spark, p, run_id, row, None)
        return ok
    tagged = {n: _tag(df, n, p).persist(StorageLevel.MEMORY_AND_DISK) for n, df in new.items() if df is not None}
    series = list(p.series_keys)
    results = None
    for n, t in tagged.items():
        rules = quality.ROW_RULES if n == "consumption" else quality.ROW_RULES[:3] if n != "calendar" else (
            "null_value", "duplicate_key")
        one = quality.row_results(t, n, rules)
        results = one if results is None else results.unionByName(one)
    good = {n: quality.clean_rows(t) for n, t in tagged.items()}
    per = quality.completeness(tagged["consumption"], good["consumption"], series, "_h", p.quality)
    last = scalar(cons.agg(F.to_date(F.max("timestamp_local"))))
    target = last + 2 * ONE_DAY
    results = results.unionByName(quality.completeness_result(per, p.quality))
    if "weather_fcst" in good and not good["weather_fcst"].isEmpty():
        fc = good["weather_fcst"].withColumn("_ih", hour_pos("forecast_issued_local"))
        cover = quality.horizon_coverage(fc, [], F.lit((target - EPOCH).days), "_ih", "_h")
        results = results.unionByName(quality.horizon_result(cover, str(target), p.forecast.horizon_hours))
    else:
        lacking = p.forecast.horizon_hours
        results = results.unionByName(spark.createDataFrame(
            [("forecast_horizon_coverage", "weather_fcst", "error", False, lacking,
              f"{target} lacks {lacking} of {lacking} forecast hours")], results.schema))
    results = results.persist(StorageLevel.MEMORY_AND_DISK)
    ok = scalar(results.agg(quality.verdict(results)))
    bad = reduce(DataFrame.unionByName, [quality.quarantine(t, n) for n, t in tagged.items()])
    _record(spark, p, run_id, results, bad)
    if ok:
        for n, df in good.items():
            keys = [*(series if RULES[n][2] else []), *SILVER_KEYS[n]]
            at = F.col("date") if n == "calendar" else F.to_date("timestamp_local")
            part = df.drop("_h").withColumn("p_day", at.cast("string"))
            T.upsert(spark, part, p.path(f"silver.{n}"), keys, "p_day")
        enter(spark, p, "silver", spark.createDataFrame(due, LEDGER))
    for df in [results, *tagged.values()]:
        df.unpersist()
    return bool(ok)


def gated_write(spark: SparkSession, clean: DataFrame, results: DataFrame, path: str, keys: list[str], partition_by: str) -> bool:
    """Upsert the clean rows of a batch if no blocking check failed; else the table stays as it is. Returns the verdict."""
    passed = bool(scalar(results.agg(quality.verdict(results).alias("passed"))))
    if passed:
        T.upsert(spark, clean, path, keys, partition_by)
    return passed


def silver_inputs(spark: SparkSession, p: Project, plan=None) -> dict[str, DataFrame]:
    """Silver as the operators expect it, cut to the read-back ranges of the plan."""
    def since(df, day):
        if plan is None:
            return df
        first = EPOCH + timedelta(days=int(day))  # the folder names prune, the raw column prunes row groups
        return df.where((F.col("p_day") >= str(first)) & (F.col("timestamp_local") >= F.lit(first).cast("timestamp_ntz")))

    s = list(p.series_keys)
    cons = since(read(spark, p, "silver.consumption"), plan and plan["demand_from"])
    fcst = since(read(spark, p, "silver.weather_fcst"), plan and plan["fcst_from"])
    obs = since(read(spark, p, "silver.weather_obs"), plan and plan["obs_from"])
    cal = read(spark, p, "silver.calendar")
    return {
        "demand": cons.select(*s, hour_pos("timestamp_local").alias("h"), F.col("demand_m3h").alias("demand")),
        "fcst": fcst.select(hour_pos("forecast_issued_local").alias("issued_h"), hour_pos("timestamp_local").alias("h"),
                            F.col("forecast_temperature_c").alias("temperature"),
                            F.col("forecast_relative_humidity_pct").alias("humidity"),
                            F.col("forecast_precipitation_mm").alias("rain"), "_row_id"),
        "obs": obs.select(hour_pos("timestamp_local").alias("h"), F.col("temperature_c").alias("temperature")),
        "calendar": cal.withColumn("day", F.datediff("date", F.lit("1970-01-01").cast("date"))),
    }


def build(spark: SparkSession, p: Project, mode: str = "daily") -> tuple[date, date]:
    """Recompute the owed target days (all of them in backfill mode) and upsert the feature table."""
    s = list(p.series_keys)
    history = silver_inputs(spark, p)["demand"]
    log = read(spark, p, "gold.demand_forecasts")
    log = None if log is None else log.select(hour_pos("target_ts").alias("h"))
    plan = features.refresh_range(history, log, backfill=mode == "backfill").first()
    src = silver_inputs(spark, p, plan)
    tgt = features.targets(history, s, plan["first_day"], plan["last_day"], spark)
    feats = features.build_features(tgt, src["demand"], src["fcst"], src["calendar"], src["obs"], s,
                                    min_lag_h=p.forecast.min_lag_hours, tie=["_row_id"])
    out = feats.withColumn("target_ts", hour_ts("h")).drop("h").withColumn(
        "feature_computed_at", F.current_timestamp()).withColumn("p_day", F.to_date("target_ts").cast("string"))
    path = p.path("gold.demand_features")
    if mode == "backfill":
        T.overwrite(out, path, ["p_day"])
    else:
        T.upsert(spark, out, path, [*s, "target_ts"], "p_day")
    return EPOCH + timedelta(days=plan["first_day"]), EPOCH + timedelta(days=plan["last_day"])


def owed_days(spark: SparkSession, p: Project) -> tuple[date, date]:
    """First and last target day without a forecast, up to tomorrow."""
    tomorrow = today_of(spark, p) + ONE_DAY
    last = newest_day(read(spark, p, "gold.demand_forecasts"), "target_ts")
    return (tomorrow if last is None else min(tomorrow, last + ONE_DAY)), tomorrow


def day_slice(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows of whole days; the partition column prunes folders and the range prunes row groups."""
    return df.where(F.col("p_day").between(str(first), str(last)) & T.ts_range(
        column, datetime(first.year, first.month, first.day), datetime(last.year, last.month, last.day) + ONE_DAY))


def incomplete_days(df: DataFrame, keys: list[str], first: date, last: date, horizon: int = 24,
                    series: DataFrame | None = None, column: str = "target_ts") -> DataFrame:
    """keys, day, rows of every owed day without exactly ``horizon`` feature rows, also of series without any row.

    ``series`` lists the series that owe a forecast; those of ``df`` by default.
    """
    spark = df.sparkSession
    day = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")
    owed = (spark.range(1) if not keys else (df if series is None else series).select(*keys).distinct()).select(*keys, day)
    have = df.groupBy(*keys, F.to_date(column).alias("day")).agg(F.count("*").alias("rows"))
    same = [owed[c].eqNullSafe(have[c]) for c in [*keys, "day"]]
    rows = F.coalesce(have["rows"], F.lit(0))
    return owed.join(have, same, "left").select(*[owed[c] for c in [*keys, "day"]], rows.alias("rows")).where(F.col("rows") != horizon)


def forecast_rows(scored: DataFrame, keys: list[str], issue_hour: int = 5, digits: int | None = 3) -> DataFrame:
    """Clip at zero, round (not at all without ``digits``), stamp with the issue time each day would have had."""
    p = F.when(F.col("pred").isNotNull(), F.greatest("pred", F.lit(0.0)))
    issued = hour_ts((day_of_hour("h") - 1) * 24 + issue_hour)
    return scored.select(*keys, hour_ts("h").alias("target_ts"), (p if digits is None else F.round(p, digits)).alias("predicted_m3"),
                         issued.alias("issued_at"))


def forecast(spark: SparkSession, p: Project, run_id: str) -> int:
    """Issue every owed day with the champion in one batch; fails when a day has no full set of features."""
    model, version = Registry(spark, p).load("champion")
    if model is None:
        raise RuntimeError("no champion: run the training job first")
    s = list(p.series_keys)
    first, last = owed_days(spark, p)
    x = day_slice(read(spark, p, "gold.demand_features"), "target_ts", first, last)
    known = read(spark, p, "silver.consumption").where(F.col("p_day") >= str(first - ACTIVE_DAYS * ONE_DAY))
    if x.isEmpty() or not incomplete_days(x, s, first, last, p.forecast.horizon_hours, known).isEmpty():
        raise RuntimeError(f"feature rows of {first}..{last} are incomplete")
    scored = model.predict(x.withColumn("h", hour_pos("target_ts")))
    rows = forecast_rows(scored, s, p.forecast.issue_hour).select(
        "*", F.lit(run_id).alias("forecast_run_id"), F.lit(p.model_name).alias("model_name"),
        F.lit(str(version["version"])).alias("model_version"), F.lit(version["family"]).alias("model_family"),
        F.lit(p.env).alias("env"), F.current_timestamp().alias("created_at"),
        F.to_date("target_ts").cast("string").alias("p_day"))
    T.append(rows, p.path("gold.demand_forecasts"), ["p_day"])
    return (last - first).days + 1


def monitor(spark: SparkSession, p: Project) -> tuple[bool, str]:
    """Score every owed day in one pass, upsert both accuracy tables, and say whether to retrain."""
    s = list(p.series_keys)
    log = read(spark, p, "gold.demand_forecasts")
    if log is None:
        return False, "no forecasts yet"
    log = log.withColumn("h", hour_pos("target_ts"))
    readings = read(spark, p, "silver.consumption")
    cols = [*s, hour_pos("timestamp_local").alias("h"), F.col("demand_m3h").alias("demand")]
    daily = read(spark, p, "monitoring.forecast_accuracy_daily")
    scored = None if daily is None else daily.select(
        F.datediff("forecast_date", F.lit("1970-01-01").cast("date")).alias("forecast_day"))
    plan = evaluate.backlog_range(readings.select(*cols), log, scored).first()
    first, last = (EPOCH + timedelta(days=plan[c]) for c in ("first_day", "last_day"))
    part = day_slice(log, "target_ts", first, last)
    hourly = evaluate.reconcile(part, day_slice(readings, "timestamp_local", first, last).select(*cols), s)
    hourly = hourly.withColumn("forecast_date", day_date("forecast_day")).withColumn(
        "p_day", F.col("forecast_date").cast("string")).persist(StorageLevel.MEMORY_AND_DISK)
    T.upsert(spark, hourly.select(*s, "forecast_date", "target_ts", "issued_at", "model_version", "predicted_m3",
                                  "actual_m3", "error_m3", "abs_pct_error", "p_day"),
             p.path("monitoring.forecast_accuracy_hourly"), [*s, "target_ts"], "p_day")
    T.upsert(spark, evaluate.daily_accuracy(hourly, [*s, "p_day"], "forecast_date"),
             p.path("monitoring.forecast_accuracy_daily"), [*s, "forecast_date"], "p_day")
    hourly.unpersist()
    daily = read(spark, p, "monitoring.forecast_accuracy_daily")
    if daily is None:
        return False, "nothing scored yet"
    champion = Registry(spark, p).version("champion")
    base = None if champion is None else champion["tags"].get("holdout_mape")
    baseline = F.lit(None if base is None else float(base)).cast("double")
    if base is None:
        return True, "the champion has no baseline"
    due = decide.needs_retrain(daily, s, baseline, "forecast_date", p.decisions).where("retrain")
    n = due.count()
    return n > 0, f"{n} series worse than {p.decisions.degradation_factor} x {float(base):.2f}% for " \
                  f"{p.decisions.degradation_days} days"


def refresh(spark: SparkSession, source: Project, target: Project, days: int = 180) -> None:
    """Copy the last ``days`` days of silver from another environment, then drop landing, bronze and the ledgers."""
    if target.env == "prod":
        return
    cons = T.scan(spark, source.path("silver.consumption"))
    latest = cons.agg(F.max("timestamp_local").alias("max_ts"))
    for name in FEEDS:
        column = None if name == "calendar" else "timestamp_local"
        src = T.scan(spark, source.path(f"silver.{name}"))
        T.overwrite(T.copy_window(src, column, latest, days), target.path(f"silver.{name}"), ["p_day"])
    for layer in ("landing", "bronze", "silver"):
        for name in [*FEEDS, "batches"] if layer != "silver" else ["batches"]:
            T.drop(spark, target.path(f"{layer}.{name}"))


def run_daily(spark: SparkSession, p: Project, feeds: dict[str, DataFrame], now_local: datetime, mode: str = "daily",
              fault: str = "none", run_id: str | None = None) -> dict:
    """One scheduled run; stops before features and forecast when the gate fails."""
    run_id = run_id or uuid.uuid4().hex[:12]
    out = {"run_id": run_id, "batch": land(spark, p, feeds, mode, now_local, fault)}
    ingest_bronze(spark, p)
    out["gate"] = quality_gate(spark, p, run_id, now_local.date(), allow_no_new=mode == "backfill")
    if not out["gate"]:
        return out
    out["features"] = build(spark, p, mode)
    if Registry(spark, p).version("champion") is not None:
        out["days"] = forecast(spark, p, run_id)
    return out


def relaxed(p: Project, **quality_overrides) -> Project:
    """The same project with other quality limits (feeds with other ranges or sparser hours)."""
    return replace(p, quality=replace(p.quality, **quality_overrides))
