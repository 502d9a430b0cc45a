"""Metering-shaped views of the test tables (the mapping is described in the README).

Money-like doubles are summed as DECIMAL so that an hourly total does not depend on the order tasks finish in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.functions.timefns import day_date, day_of_hour, day_pos, hour_of_day, hour_pos, hour_ts

CENTS = "decimal(12,2)"


# Declared schemas of the tables the operators read: no footer pass before the first job.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf}/{name}.parquet")


def exact_sum(c) -> F.col:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(CENTS)).cast("double")


def exact_avg(c) -> F.col:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(CENTS)).cast("double") / F.count(c)


def events(spark: SparkSession, sf: str) -> DataFrame:
    """events with series, hour position ``h`` and the raw value."""
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("series"), hour_pos("ts").alias("h"), "value", "user_id")


def demand(spark: SparkSession, sf: str) -> DataFrame:
    """series, h, demand: hourly totals per event type, gappy on small data."""
    return events(spark, sf).groupBy("series", "h").agg(exact_sum("value").alias("demand"))


def demand_total(spark: SparkSession, sf: str) -> DataFrame:
    """h, demand over all event types: one series without a key."""
    return events(spark, sf).groupBy("h").agg(exact_sum("value").alias("demand"))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """series, h, n: events per hour; equal neighbouring counts play the stuck meter."""
    return events(spark, sf).groupBy("series", "h").agg(F.count("*").alias("n"))


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """One raw reading per event: several versions of a (series, hour), some nulls, some spikes."""
    return events(spark, sf).select(
        "series", "h", F.col("event_id").alias("row_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("value")).alias("demand"))


def weather_obs(spark: SparkSession, sf: str) -> DataFrame:
    """h, temperature, humidity, rain: hourly means of the 'view' events."""
    view = table(spark, sf, "events").where(F.col("event_type") == "view")
    wet = F.when(F.col("event_id") % 11 == 0, F.col("value")).otherwise(0.0)
    return view.groupBy(hour_pos("ts").alias("h")).agg(
        exact_avg("value").alias("temperature"),
        exact_avg(F.col("user_id") % 100).alias("humidity"),
        exact_sum(wet).alias("rain"))


def vintages(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast vintages: issued at 06:00 of the event's day for one of the 41 hours from the next midnight.

    issued_h and h are hour positions; several rows share a key, ``row_id`` breaks the tie.
    """
    e = table(spark, sf, "events")
    day = day_pos("ts")
    return e.select(
        (day * 24 + 6).alias("issued_h"),
        ((day + 1) * 24 + (F.col("event_id") % 41)).cast("int").alias("h"),
        F.col("value").alias("temperature"), (F.col("user_id") % 100).cast("double").alias("humidity"),
        F.when(F.col("event_id") % 13 == 0, F.col("value")).otherwise(0.0).alias("rain"),
        F.col("event_id").alias("row_id"))


def calendar_rule(day) -> list:
    """Deterministic calendar facts of a day position (day 0 of the pattern is 2024-01-01)."""
    n = day - 19723
    holiday = F.pmod(n, F.lit(10)) == 9
    ramadan = F.pmod(n, F.lit(30)).between(10, 19)
    event = F.pmod(n, F.lit(12))
    kind = F.when(event == 3, "structural").when(event == 5, "operational").when(event.isin(7, 8), "weather")
    return [
        holiday.alias("is_public_holiday"),
        F.when(F.pmod(n, F.lit(20)) == 19, "Eid al-Fitr").when(holiday, "Founding Day").alias("holiday_name"),
        (F.pmod(day + 3, F.lit(7)) >= 5).alias("is_weekend"),
        ramadan.alias("is_ramadan"),
        F.when(ramadan, F.pmod(n, F.lit(30)) - 9).otherwise(0).cast("int").alias("ramadan_day"),
        (F.pmod(n, F.lit(14)) < 3).alias("is_school_break"),
        kind.alias("event_type"),
        F.when(kind.isNotNull(), F.concat(F.lit("event-"), kind)).alias("event_name"),
    ]


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """day, calendar facts: every day the events touch and the three after."""
    span = table(spark, sf, "events").agg(F.min(day_pos("ts")).alias("lo"), F.max(day_pos("ts")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", F.col("hi") + 3)).alias("day"))
    return days.select("day", day_date("day").alias("date"), *calendar_rule(F.col("day")))


def long_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The same calendar over the order dates."""
    span = table(spark, sf, "orders").agg(F.min(day_pos("o_orderdate")).alias("lo"),
                                          F.max(day_pos("o_orderdate")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.select("day", day_date("day").alias("date"), *calendar_rule(F.col("day")))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with the calendar facts of its day; the calendar is a row per day and is broadcast."""
    return table(spark, sf, "orders").withColumn("day", day_pos("o_orderdate")).join(
        F.broadcast(long_calendar(spark, sf)), "day")


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the calendar facts of its day."""
    return table(spark, sf, "events").withColumn("day", day_pos("ts")).join(F.broadcast(
        calendar(spark, sf).withColumnRenamed("event_type", "day_event")), "day")


def daily_long(spark: SparkSession, sf: str) -> DataFrame:
    """day, y: mean order value per day over more than six years; one series."""
    return table(spark, sf, "orders").groupBy(day_pos("o_orderdate").alias("day")).agg(
        exact_avg("o_totalprice").alias("y"))


def daily_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """series (order priority), day, y: order value per day."""
    return table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), day_pos("o_orderdate").alias("day")).agg(
        exact_sum("o_totalprice").alias("y"))


def with_clock(df: DataFrame) -> DataFrame:
    """Add ts, day and hour of day to a frame positioned by ``h``."""
    return df.select("*", hour_ts("h").alias("ts"), day_of_hour("h").alias("day"), hour_of_day("h").alias("hour"))


def feeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four raw feeds with their stored column names; the event type is the site."""
    r = readings(spark, sf)
    consumption = r.select(
        hour_ts("h").alias("timestamp_local"), hour_ts(F.col("h") - 4).alias("timestamp_utc"),
        F.col("series").alias("site_id"), F.col("demand").alias("demand_m3h"), F.lit("events").alias("source_system"),
        F.when(F.col("demand").isNull(), "telemetry gap").when(F.col("demand") > 200, "spike").alias("quality_note"),
        "row_id")
    o = weather_obs(spark, sf)
    obs = o.select(F.lit("view").alias("location"), hour_ts("h").alias("timestamp_local"),
                   hour_ts(F.col("h") - 4).alias("timestamp_utc"), F.col("temperature").alias("temperature_c"),
                   F.col("humidity").alias("relative_humidity_pct"), F.col("rain").alias("precipitation_mm"))
    v = vintages(spark, sf)
    fcst = v.select(hour_ts("issued_h").alias("forecast_issued_local"), hour_ts("h").alias("timestamp_local"),
                    F.col("temperature").alias("forecast_temperature_c"),
                    F.col("humidity").alias("forecast_relative_humidity_pct"),
                    F.col("rain").alias("forecast_precipitation_mm"), "row_id")
    return {"consumption": consumption, "weather_obs": obs, "weather_fcst": fcst,
            "calendar": calendar(spark, sf).drop("day")}


def wide_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """series, h, y and three seasonal-naive forecasts of the hour, where all of them exist."""
    from flowgrid.operators.series import lag_join

    d = demand(spark, sf)
    lags = {"naive_48": 48, "naive_168": 168, "_l336": 336, "_l504": 504}
    w = lag_join(d.withColumnRenamed("demand", "y"), d, ["series"], "h", "demand", lags)
    w = w.withColumn("mean_3w", (F.col("naive_168") + F.col("_l336") + F.col("_l504")) / 3)
    return w.where(F.col("naive_48").isNotNull() & F.col("mean_3w").isNotNull()).drop("_l336", "_l504")


MODELS = ["naive_48", "naive_168", "mean_3w"]


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """series, h, y, model, pred, fold (week number)."""
    pairs = ", ".join(f"'{m}', {m}" for m in MODELS)
    w = wide_predictions(spark, sf)
    return w.selectExpr("series", "h", "y", f"stack({len(MODELS)}, {pairs}) as (model, pred)").withColumn(
        "fold", F.floor((F.col("h") / 24 + 3) / 7).cast("int"))


def wide_long(spark: SparkSession, sf: str) -> DataFrame:
    """day, y and three seasonal-naive forecasts of the long daily series, where all of them exist."""
    from flowgrid.operators.series import DAY_CHUNK, banded

    d = daily_long(spark, sf)
    frames = {f"l{k}": (-k, -k, lambda w: F.max("y").over(w)) for k in (7, 14, 21, 364)}
    w = banded(d, [], "day", frames, DAY_CHUNK)
    w = w.select("day", "y", F.col("l7").alias("naive_7"), F.col("l364").alias("naive_364"),
                 ((F.col("l7") + F.col("l14") + F.col("l21")) / 3).alias("mean_3w"))
    return w.where(F.col("naive_7").isNotNull() & F.col("naive_364").isNotNull() & F.col("mean_3w").isNotNull())


LONG_MODELS = ["naive_7", "naive_364", "mean_3w"]


def long_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """day, y, model, pred, fold (first day of the calendar month)."""
    pairs = ", ".join(f"'{m}', {m}" for m in LONG_MODELS)
    return wide_long(spark, sf).selectExpr(
        "day", "y", f"stack({len(LONG_MODELS)}, {pairs}) as (model, pred)").withColumn(
        "fold", F.trunc(day_date("day"), "month"))


def forecast_log(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only log: every hour forecast twice, odd hours re-issued an hour later, even hours re-run at once."""
    w = wide_predictions(spark, sf)
    issue = ((day_of_hour("h") - 1) * 24 + 5).cast("int")
    first = F.struct(issue.alias("issued_h"), F.lit(1).alias("created_seq"), F.lit("1").alias("model_version"),
                     F.round("naive_168", 3).alias("predicted_m3"))
    second = F.struct((issue + F.pmod("h", F.lit(2))).cast("int").alias("issued_h"), F.lit(2).alias("created_seq"),
                      F.lit("2").alias("model_version"), F.round("mean_3w", 3).alias("predicted_m3"))
    return w.select("series", "h", F.explode(F.array(first, second)).alias("_i")).select("series", "h", "_i.*")
