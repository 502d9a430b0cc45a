"""The tables behind the four dashboard pages: daily operations, accuracy detail, data quality, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.scalars import ratio
from flowgrid.functions.timefns import day_of_hour, hour_of_day
from flowgrid.operators.evaluate import latest_forecast


def operations(log: DataFrame, daily: DataFrame, keys: list[str], recent: int = 7) -> DataFrame:
    """Key figures of each series: its newest forecast day (hours, total, peak hour), the newest scored day and its MAPE, the
    MAPE of the last ``recent`` scored days and the worst day so far. ``daily`` is the daily accuracy table."""
    best = latest_forecast(log, keys).withColumn("day", day_of_hour("h"))
    per_day = best.groupBy(*keys, "day").agg(F.count("*").alias("forecast_hours"), F.sum("predicted_m3").alias("forecast_total"),
                                             F.max_by(hour_of_day("h"), F.struct("predicted_m3", -F.col("h"))).alias("peak_hour"))
    newest = per_day.groupBy(*keys).agg(F.max_by(F.struct("day", "forecast_hours", "forecast_total", "peak_hour"), "day").alias("_f"))
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("forecast_day")))  # a row for each day
    scored = daily.withColumn("_back", back).groupBy(*keys).agg(
        F.count("*").alias("scored_days"), F.max("forecast_day").alias("scored_day"), F.max(F.when(F.col("_back") == 1, F.col("mape"))).alias("last_mape"),
        F.avg(F.when(F.col("_back") <= recent, F.col("mape"))).alias("recent_mape"), F.max("mape").alias("worst_mape"))
    return newest.join(scored, keys, "left").select(*keys, "_f.*", "scored_days", "scored_day", "last_mape", "recent_mape", "worst_mape")


def accuracy(hourly: DataFrame, keys: list[str]) -> DataFrame:
    """Errors by hour of day: hours scored, MAPE, bias and the share of hours with an error above 20 %. ``hourly`` is the
    reconciled forecast table."""
    return hourly.groupBy(*keys, hour_of_day("h").alias("hour")).agg(
        F.count("*").alias("hours"), F.avg("abs_pct_error").alias("mape"), (ratio(F.sum("error_m3"), F.sum("actual_m3")) * 100).alias("bias_pct"),
        (F.avg((F.col("abs_pct_error") > 20).cast("double")) * 100).alias("large_pct"))


def quality(tagged: DataFrame, reasons: tuple[str, ...], keys: list[str], pos: str = "h") -> DataFrame:
    """Rows of a day by series: all, clean, and those that each rule took."""
    return tagged.groupBy(*keys, day_of_hour(pos).alias("day")).agg(
        F.count("*").alias("rows"), F.count(F.when(F.col("reason").isNull(), 1)).alias("clean"),
        *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in reasons])


def models(log: DataFrame, hourly: DataFrame, keys: list[str]) -> DataFrame:
    """History of a model version by week: hours it issued, hours for which its forecast counted, and their MAPE."""
    week = F.floor((day_of_hour("h") + 3) / 7).cast("int").alias("week")
    issued = log.groupBy("model_version", week).agg(F.count("*").alias("issued"))
    used = hourly.groupBy("model_version", week).agg(F.count("*").alias("used"), F.avg("abs_pct_error").alias("mape"))
    return issued.join(used, ["model_version", "week"], "left").withColumn("used", F.coalesce("used", F.lit(0).cast("bigint")))
