"""Forecast vintages: issue time x target time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.functions.timefns import day_of_hour


def day_ahead_vintage(fcst: DataFrame, keys: list[str], values: list[str], tie: list[str],
                      issued: str = "issued_h", pos: str = "h") -> DataFrame:
    """As-of pick: per target hour the latest vintage issued on the day before the target day.

    The day condition is an equality, so the as-of join is a filter plus one ``max_by`` aggregate - no theta join.
    """
    eve = fcst.where(day_of_hour(issued) == day_of_hour(pos) - 1)
    row = F.max_by(F.struct(issued, *values), F.struct(issued, *tie)).alias("_v")
    return eve.groupBy(*keys, pos).agg(row).select(*keys, pos, *[F.col("_v")[c].alias(c) for c in [issued, *values]])


def daily_mean(df: DataFrame, keys: list[str], value: str, out: str, pos: str = "h") -> DataFrame:
    return df.groupBy(*keys, day_of_hour(pos).alias("day")).agg(F.avg(value).alias(out))


def shift_days(daily: DataFrame, days: int, rename: dict[str, str]) -> DataFrame:
    """The daily table as seen ``days`` later."""
    keep = [c for c in daily.columns if c != "day" and c not in rename]
    return daily.select(*keep, (F.col("day") + days).alias("day"), *[F.col(a).alias(b) for a, b in rename.items()])


def lead_hours(issued: str = "issued_h", pos: str = "h"):
    return F.col(pos) - F.col(issued)
