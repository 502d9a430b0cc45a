from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, partitions=4)


def hours(spark, first: str, last: str):
    """ts of every hour of the days first..last."""
    return spark.sql(f"SELECT explode(sequence(timestamp_ntz'{first} 00:00:00', timestamp_ntz'{last} 23:00:00', "
                     "interval 1 hour)) AS ts")


FIRST, LAST = "2025-03-01", "2025-05-10"


@pytest.fixture(scope="session")
def raw(spark):
    """A clean feed of 71 days: deterministic demand, weather, two overlapping vintages per hour, calendar."""
    h = hours(spark, FIRST, LAST)
    cons = h.selectExpr(
        "ts AS timestamp_local", "ts - interval 4 hours AS timestamp_utc", "'SITE-1' AS site_id",
        "round(100000 * (1 + 0.3 * sin(2 * pi() * (hour(ts) - 8) / 24)) "
        "+ (abs(hash(cast(ts as string))) % 4000) - 2000, 1) AS demand_m3h",
        "'test' AS source_system", "cast(null AS string) AS quality_note")
    obs = h.selectExpr(
        "'CITY' AS location", "ts AS timestamp_local", "ts - interval 4 hours AS timestamp_utc",
        "round(20 + 8 * sin(2 * pi() * (hour(ts) - 9) / 24) + (abs(hash(cast(ts as string), 1)) % 100) / 100.0, 2) "
        "AS temperature_c", "40.0D AS relative_humidity_pct", "0.0D AS precipitation_mm")
    fcst = spark.sql(
        "SELECT issued AS forecast_issued_local, ts AS timestamp_local, "
        "round(20 + 8 * sin(2 * pi() * (hour(ts) - 9) / 24) + (abs(hash(cast(issued as string), cast(ts as string))) "
        "% 200) / 100.0, 2) AS forecast_temperature_c, 45.0D AS forecast_relative_humidity_pct, "
        "0.0D AS forecast_precipitation_mm FROM (SELECT d + interval 6 hours AS issued, explode(sequence("
        "d + interval 24 hours, d + interval 64 hours, interval 1 hour)) AS ts FROM (SELECT explode(sequence("
        "timestamp_ntz'2025-02-28 00:00:00', timestamp_ntz'2025-05-11 00:00:00', interval 1 day)) AS d))")
    cal = spark.sql(
        "SELECT d AS date, if(d = date'2025-04-21', 'Eid al-Fitr', null) AS holiday_name, "
        "d = date'2025-04-21' AS is_public_holiday, date_format(d, 'EEEE') AS day_of_week, weekday(d) >= 5 AS is_weekend, "
        "d BETWEEN date'2025-04-25' AND date'2025-04-27' AS is_ramadan, "
        "if(d BETWEEN date'2025-04-25' AND date'2025-04-27', datediff(d, date'2025-04-24'), 0) AS ramadan_day, "
        "d BETWEEN date'2025-04-25' AND date'2025-04-27' AS is_school_break, "
        "if(d = date'2025-04-23', 'Test Event', null) AS event_name, "
        "if(d = date'2025-04-23', 'structural', null) AS event_type, cast(null AS string) AS event_note "
        "FROM (SELECT explode(sequence(date'2025-02-27', date'2025-05-14', interval 1 day)) AS d)")
    frames = {"consumption": cons, "weather_obs": obs, "weather_fcst": fcst, "calendar": cal}
    return {k: v.cache() for k, v in frames.items()}


@pytest.fixture(scope="session")
def inputs(raw):
    """The feed as the operators take it: positions instead of timestamps."""
    from pyspark.sql import functions as F

    from flowgrid.functions.timefns import day_pos, hour_pos

    return {
        "demand": raw["consumption"].select(hour_pos("timestamp_local").alias("h"), F.col("demand_m3h").alias("demand")),
        "obs": raw["weather_obs"].select(hour_pos("timestamp_local").alias("h"),
                                         F.col("temperature_c").alias("temperature")),
        "fcst": raw["weather_fcst"].select(
            hour_pos("forecast_issued_local").alias("issued_h"), hour_pos("timestamp_local").alias("h"),
            F.col("forecast_temperature_c").alias("temperature"),
            F.col("forecast_relative_humidity_pct").alias("humidity"), F.col("forecast_precipitation_mm").alias("rain")),
        "calendar": raw["calendar"].withColumn("day", day_pos("date")),
    }
