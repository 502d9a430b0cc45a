"""Leakage-safe feature table: everything a row uses is known when its forecast is issued."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid import config as C
from flowgrid.functions.scalars import above, below, flag, fourier
from flowgrid.functions.timefns import day_date, day_of_hour, day_pos, hour_of_day, weekday_of
from flowgrid.operators.series import banded
from flowgrid.operators.vintages import daily_mean, day_ahead_vintage, shift_days

# Names and order of the model columns.
LEVEL_FEATURES = ["lag_48h", "lag_72h", "lag_168h", "lag_336h", "lag_504h",
                  "roll_mean_7d", "roll_std_7d", "same_hour_mean_3w"]
WEATHER_FEATURES = ["fc_temperature_c", "fc_humidity_pct", "fc_precipitation_mm", "fc_temp_max_day",
                    "fc_precip_total_day", "fc_cooling_degree", "fc_heating_degree"]
CALENDAR_FEATURES = ["hour", "day_of_week", "month", "is_weekend", "is_holiday", "is_day_off",
                     "day_before_holiday", "day_after_holiday", "is_ramadan", "ramadan_day", "is_school_break",
                     "event_structural", "event_operational", "event_weather"]
FOURIER_FEATURES = ["hour_sin1", "hour_cos1", "hour_sin2", "hour_cos2", "dow_sin", "dow_cos", "doy_sin", "doy_cos"]
EXTRA_FEATURES = ["fc_tmean_day", "fc_cdd24_day", "fc_cdd24_hour", "fc_tmean_prev_day", "obs_tmean_d2", "is_eid"]
TREND_FEATURE = "t_days"
FIRST_VERSION = LEVEL_FEATURES + WEATHER_FEATURES + CALENDAR_FEATURES + FOURIER_FEATURES
FEATURES = FIRST_VERSION + EXTRA_FEATURES
MODEL_COLUMNS = FEATURES + [TREND_FEATURE]


def targets(series: DataFrame | None, keys: list[str], first_day: int, last_day: int, spark=None) -> DataFrame:
    """Every hour of the days [first_day, last_day] for every series (one anonymous series without keys)."""
    hours = F.explode(F.sequence(F.lit(first_day * 24), F.lit(last_day * 24 + 23))).alias("h")
    if keys:
        return series.select(*keys).distinct().select(*keys, hours)
    return spark.range(1).select(hours)


def level_features(tgt: DataFrame, demand: DataFrame, keys: list[str], min_lag_h: int = C.MIN_LAG_H,
                   lags: tuple[int, ...] = C.LAGS_H) -> DataFrame:
    """Lags, trailing week and same-hour mean in one banded window over readings and targets together.

    A lag is the RANGE frame [-k, -k], so gaps stay gaps; the whole set costs one shuffle of the readings.
    """
    if min(lags) < min_lag_h:
        raise ValueError(f"a {min(lags)}h lag would leak: the shortest allowed is {min_lag_h}h")
    reach = (-(min_lag_h + C.ROLL_WIDTH_H - 1), -min_lag_h)
    both = demand.select(*keys, "h", "demand", F.lit(False).alias("_target")).unionByName(
        tgt.select(*keys, "h", F.lit(None).cast("double").alias("demand"), F.lit(True).alias("_target")))
    frames = {f"lag_{k}h": (-k, -k, lambda w: F.max("demand").over(w)) for k in lags}
    frames |= {"_n": (*reach, lambda w: F.count("demand").over(w)),
               "_m": (*reach, lambda w: F.avg("demand").over(w)),
               "_s": (*reach, lambda w: F.stddev_samp("demand").over(w))}
    out = banded(both, keys, "h", frames, where=F.col("_target"))
    enough = F.col("_n") >= C.ROLL_LEAST_H
    made = {"roll_mean_7d": F.when(enough, F.col("_m")), "roll_std_7d": F.when(enough, F.col("_s"))}
    if {168, 336, 504} <= set(lags):
        made["same_hour_mean_3w"] = (F.col("lag_168h") + F.col("lag_336h") + F.col("lag_504h")) / 3
    return out.withColumns(made).drop("_target", "_n", "_m", "_s", "demand")


def weather_features(df: DataFrame, fcst: DataFrame, keys: list[str], weather_keys: list[str],
                     tie: list[str]) -> DataFrame:
    """Forecast features from the vintage issued on the eve, and daily means for persistence.

    ``fc_temp_max_day`` and ``fc_precip_total_day`` look at the target rows of the day, ``fc_tmean_*`` at every
    selected vintage hour of the day.
    """
    pick = day_ahead_vintage(fcst, weather_keys, ["temperature", "humidity", "rain"], tie)
    hourly = pick.select(*weather_keys, "h", F.col("temperature").alias("fc_temperature_c"),
                         F.col("humidity").alias("fc_humidity_pct"), F.col("rain").alias("fc_precipitation_mm"))
    day_mean = daily_mean(hourly, weather_keys, "fc_temperature_c", "fc_tmean_day")
    eve_mean = shift_days(day_mean, 1, {"fc_tmean_day": "fc_tmean_prev_day"})
    out = df.join(hourly, [*weather_keys, "h"], "left").withColumn("day", day_of_hour("h"))
    per_day = out.groupBy(*keys, "day").agg(F.max("fc_temperature_c").alias("fc_temp_max_day"),
                                            F.sum("fc_precipitation_mm").alias("fc_precip_total_day"))
    t = F.col("fc_temperature_c")
    return (out.join(per_day, [*keys, "day"], "left")
            .join(day_mean, [*weather_keys, "day"], "left").join(eve_mean, [*weather_keys, "day"], "left")
            .withColumns({"fc_cooling_degree": above(t, C.COOLING_BASE_C),
                          "fc_heating_degree": below(t, C.HEATING_BASE_C),
                          "fc_cdd24_hour": above(t, C.COOLING_KNOT_C),
                          "fc_cdd24_day": above("fc_tmean_day", C.COOLING_KNOT_C)}))


def observed_features(df: DataFrame, obs: DataFrame, weather_keys: list[str]) -> DataFrame:
    """Observed mean temperature two days before the target day."""
    mean = daily_mean(obs, weather_keys, "temperature", "_tmean")
    return df.join(shift_days(mean, 2, {"_tmean": "obs_tmean_d2"}), [*weather_keys, "day"], "left")


CALENDAR_FLAGS = ["is_holiday", "is_ramadan", "ramadan_day", "is_school_break", "is_eid",
                  *[f"event_{e}" for e in C.EVENT_TYPES], "day_before_holiday", "day_after_holiday"]


def calendar_table(calendar: DataFrame) -> DataFrame:
    """One row per day with the flags of the day and of its neighbours.

    Each holiday also marks the day before and after it, so no day looks anything up. One row per calendar day:
    about 37,000 a century, which is what makes broadcasting it safe.
    """
    facts = calendar.select(
        "day", flag(F.col("is_public_holiday")).alias("is_holiday"), flag(F.col("is_ramadan")).alias("is_ramadan"),
        F.coalesce(F.col("ramadan_day").cast("double"), F.lit(0.0)).alias("ramadan_day"),
        flag(F.col("is_school_break")).alias("is_school_break"),
        flag(F.col("holiday_name").contains("Eid")).alias("is_eid"),
        *[flag(F.col("event_type") == e).alias(f"event_{e}") for e in C.EVENT_TYPES])
    names = CALENDAR_FLAGS[:-2]
    one = facts.groupBy("day").agg(F.min(F.struct(*names)).alias("_f")).select(
        "day", *[F.col("_f")[n].alias(n) for n in names])
    zeros = [F.lit(0.0).alias(n) for n in names]
    marks = CALENDAR_FLAGS[-2:]
    hol = one.where(F.col("is_holiday") == 1)
    parts = one.select("day", *names, *[F.lit(0.0).alias(m) for m in marks])
    for mark, step in zip(marks, (-1, 1)):
        parts = parts.unionByName(hol.select(
            (F.col("day") + step).alias("day"), *zeros, *[F.lit(1.0 if m == mark else 0.0).alias(m) for m in marks]))
    return parts.groupBy("day").agg(*[F.max(n).alias(n) for n in [*names, *marks]])


def calendar_features(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Clock parts of the target hour and the calendar flags of its day (absent days get zeros)."""
    cal = calendar_table(calendar)
    out = df.join(F.broadcast(cal), "day", "left")
    dow = weekday_of("day")
    weekend = (dow >= 5).cast("double")
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in CALENDAR_FLAGS}
    return out.withColumns({
        **zero, "hour": hour_of_day("h").cast("double"), "day_of_week": dow.cast("double"),
        "month": F.month(day_date("day")).cast("double"), "is_weekend": weekend,
        "is_day_off": F.greatest(weekend, zero["is_holiday"])})


def fourier_features(df: DataFrame) -> DataFrame:
    pairs = {"hour_sin1": fourier("hour", 24)[0], "hour_cos1": fourier("hour", 24)[1],
             "hour_sin2": fourier("hour", 24, 2)[0], "hour_cos2": fourier("hour", 24, 2)[1],
             "dow_sin": fourier("day_of_week", 7)[0], "dow_cos": fourier("day_of_week", 7)[1]}
    doy = F.dayofyear(day_date("day"))
    pairs |= {"doy_sin": fourier(doy, 365.25)[0], "doy_cos": fourier(doy, 365.25)[1]}
    return df.withColumns(pairs)


def trend_feature(df: DataFrame) -> DataFrame:
    """Fractional days since the trend origin."""
    origin = day_pos(F.lit(C.TREND_ORIGIN).cast("date")) * 24
    return df.withColumn(TREND_FEATURE, (F.col("h") - origin) / F.lit(24.0))


def build_features(tgt: DataFrame, demand: DataFrame, fcst: DataFrame, calendar: DataFrame, obs: DataFrame,
                   keys: list[str], weather_keys: list[str] | None = None, min_lag_h: int = C.MIN_LAG_H,
                   tie: list[str] | None = None) -> DataFrame:
    """One row per target with the key, ``h`` and every model column as DOUBLE.

    demand: keys, h, demand. fcst: weather_keys, issued_h, h, temperature, humidity, rain and the ``tie`` columns.
    obs: weather_keys, h, temperature. calendar: day and the calendar facts.
    """
    weather_keys = weather_keys or []
    df = level_features(tgt.select(*keys, "h"), demand, keys, min_lag_h)
    df = weather_features(df, fcst, keys, weather_keys, tie or [])
    df = observed_features(df, obs, weather_keys)
    df = trend_feature(fourier_features(calendar_features(df, calendar)))
    return df.select(*keys, "h", *[F.col(c).cast("double").alias(c) for c in MODEL_COLUMNS])


def attach_label(features: DataFrame, demand: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with the actual of the target hour."""
    return features.join(demand.select(*keys, "h", "demand"), [*keys, "h"])


def training_frame(features: DataFrame, demand: DataFrame, keys: list[str]) -> DataFrame:
    """Labelled rows with a complete lag history."""
    return attach_label(features, demand, keys).where(F.col("lag_504h").isNotNull())


def refresh_range(history: DataFrame, log: DataFrame | None, pos: str = "h", backfill: bool = False,
                  warmup_days: int = 21) -> DataFrame:
    """One row: first and last target day to recompute, and how far back each input is read.

    backfill starts after the warm-up; otherwise the last two days are replayed for late corrections and the range
    reaches back to the first day without a forecast. "today" is the day after the newest reading.
    """
    ends = history.agg(F.min(day_of_hour(pos)).alias("oldest"), (F.max(day_of_hour(pos)) + 1).alias("today"))
    if backfill:
        ends = ends.withColumn("first_day", F.col("oldest") + warmup_days)
    else:
        first = F.col("today") - 2
        if log is not None:
            owed = log.agg((F.max(day_of_hour(pos)) + 1).alias("_owed"))
            ends = ends.unionByName(owed, allowMissingColumns=True).agg(
                *[F.max(c).alias(c) for c in ("oldest", "today", "_owed")])
            first = F.least(first, F.coalesce(F.col("_owed"), first))
        ends = ends.withColumn("first_day", first)
    return ends.select(
        "today", "first_day", (F.col("today") + 1).alias("last_day"),
        (F.col("first_day") - 30).alias("demand_from"), (F.col("first_day") - 1).alias("fcst_from"),
        (F.col("first_day") - 2).alias("obs_from"))


def what_if_lag24(tgt: DataFrame, demand: DataFrame, keys: list[str]) -> DataFrame:
    """Research only: value and daily mean 24 hours back, as if the forecast were issued at midnight."""
    both = demand.select(*keys, "h", "demand", F.lit(False).alias("_t")).unionByName(
        tgt.select(*keys, "h", F.lit(None).cast("double").alias("demand"), F.lit(True).alias("_t")))
    near = banded(both, keys, "h", {"lag_24h": (-24, -24, lambda w: F.max("demand").over(w))}, where=F.col("_t"))
    mean = shift_days(daily_mean(demand, keys, "demand", "_m"), 1, {"_m": "lag_24h_daymean"})
    return (near.drop("_t", "demand").withColumn("day", day_of_hour("h"))
            .join(mean, [*keys, "day"], "left").drop("day"))
