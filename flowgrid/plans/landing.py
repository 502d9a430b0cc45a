"""Which days to land: the whole gap since the last landed day, in one batch, decided on day-number columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.functions.timefns import day_of_hour


def due_days(landed: DataFrame, today: Column, history: tuple[int, int] | None = None) -> DataFrame:
    """One row (high_water, first_day, last_day); first_day is null when nothing is due.

    ``landed`` holds ``high_water`` per table or series, possibly none. ``history`` is the span of a backfill, which
    ends yesterday at the latest and is due only while nothing has landed.
    """
    mark, yesterday = F.col("high_water"), today - 1
    one = landed.agg(F.max("high_water").alias("high_water"))
    if history is None:
        first, last = F.when(mark < yesterday, mark + 1), yesterday
    else:
        first, last = F.when(mark.isNull(), F.lit(history[0])), F.least(F.lit(history[1]), yesterday)
    return one.select("high_water", first.alias("first_day"), F.when(first.isNotNull(), last).alias("last_day"))


def missing_days(high_water: DataFrame, keys: list[str], today: Column) -> DataFrame:
    """keys, day: every complete day after the high-water mark of each series."""
    gaps = high_water.withColumn("_to", today - 1).where(F.col("_to") > F.col("high_water"))
    return gaps.select(*keys, F.explode(F.sequence(F.col("high_water") + 1, F.col("_to"))).alias("day"))


def issue_day(history: DataFrame, keys: list[str], pos: str = "h") -> DataFrame:
    """keys, today: the day after the newest reading of each series."""
    return history.groupBy(*keys).agg((F.max(day_of_hour(pos)) + 1).alias("today"))
