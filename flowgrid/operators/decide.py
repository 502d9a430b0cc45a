"""Promotion and retraining decisions as column rules, for one model or many series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.config import Decisions
from flowgrid.functions.timefns import day_of_hour


def promotion(errors: DataFrame, d: Decisions = Decisions()) -> DataFrame:
    """``errors`` (challenger, champion) with promote, gain_pct and reason, a row per model or series."""
    gain = F.try_divide(F.col("champion") - F.col("challenger"), F.col("champion")) * 100
    judged = errors.withColumn("gain_pct", gain).withColumn("promote", promote_column(F.col("challenger"), F.col("champion"), d))
    why = F.format_string(f"error %.3f against %s; ceiling {d.max_acceptable_mape:g}, least gain {d.min_improvement_pct:g} percent",
                          F.col("challenger"), F.coalesce(F.format_string("%.3f", "champion"), F.lit("no champion")))
    return judged.withColumn("reason", why)


def promote_column(challenger: Column, champion: Column, d: Decisions = Decisions()) -> Column:
    """Below the ceiling, and without a champion or better by the least relative gain."""
    enough = F.try_divide(champion - challenger, champion) * 100 >= d.min_improvement_pct
    return (challenger <= d.max_acceptable_mape) & (champion.isNull() | F.coalesce(enough, F.lit(False)))


def fair_hours(df: DataFrame, trained_through: Column, keys: list[str], pos: str = "h",
               d: Decisions = Decisions()) -> DataFrame:
    """Per key: hours and days of the holdout the champion has not seen, and whether they are enough.

    A champion without a training-end tag is compared on everything.
    """
    unseen = trained_through.isNull() | (F.col(pos) > trained_through)
    tagged = df.withColumn("_unseen", unseen).withColumn("_free", trained_through.isNull())
    out = tagged.groupBy(*keys).agg(
        F.count(F.when(F.col("_unseen"), 1)).alias("hours"),
        F.count_distinct(F.when(F.col("_unseen"), day_of_hour(pos))).alias("days"),
        F.coalesce(F.max("_free"), F.lit(False)).alias("_free"))
    return out.withColumn("comparable", F.col("_free") | (F.col("days") >= d.min_fresh_days)).drop("_free")


def needs_retrain(history: DataFrame, keys: list[str], baseline: Column, day: str = "forecast_day",
                  d: Decisions = Decisions()) -> DataFrame:
    """Per key: are the last days all worse than factor x baseline?

    ``row_number`` with a limit prunes to the last few days per key before the shuffle.
    """
    last = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    recent = history.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") <= d.degradation_days)
    worse = F.coalesce(F.col("mape") > baseline * d.degradation_factor, F.lit(False))
    agg = recent.withColumn("_worse", worse).withColumn("_none", baseline.isNull()).groupBy(*keys).agg(
        F.count("*").alias("days"), F.min("_worse").alias("all_worse"), F.max("_none").alias("_none"))
    decision = F.when(F.col("_none"), True).otherwise((F.col("days") >= d.degradation_days) & F.col("all_worse"))
    return agg.select(*keys, "days", "all_worse", decision.alias("retrain"))
