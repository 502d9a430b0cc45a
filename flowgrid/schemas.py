"""Explicit schemas of every stored table (DDL text understood by ``StructType.fromDDL`` and readers)."""

from __future__ import annotations

from pyspark.sql import types as T

CONSUMPTION = ("timestamp_local timestamp_ntz, timestamp_utc timestamp_ntz, site_id string, demand_m3h double, "
               "source_system string, quality_note string")
WEATHER_OBS = ("location string, timestamp_local timestamp_ntz, timestamp_utc timestamp_ntz, temperature_c double, "
               "apparent_temperature_c double, relative_humidity_pct double, precipitation_mm double, "
               "wind_speed_kmh double, solar_radiation_wm2 double, weather_source string")
WEATHER_FCST = ("forecast_issued_local timestamp_ntz, timestamp_local timestamp_ntz, forecast_temperature_c double, "
                "forecast_relative_humidity_pct double, forecast_precipitation_mm double, forecast_source string")
CALENDAR = ("date date, holiday_name string, is_public_holiday boolean, day_of_week string, is_weekend boolean, "
            "is_ramadan boolean, ramadan_day int, is_school_break boolean, event_name string, event_type string, "
            "event_note string")
DQ_RESULTS = ("check_name string, table_name string, severity string, passed boolean, failed_rows bigint, "
              "detail string, run_id string, env string, checked_at timestamp")
DQ_QUARANTINE = "table_name string, reason string, record_json string, run_id string, detected_at timestamp"
FORECASTS = ("target_ts timestamp_ntz, predicted_m3 double, forecast_run_id string, issued_at timestamp_ntz, "
             "model_name string, model_version string, model_family string, env string, created_at timestamp")
ACCURACY_HOURLY = ("forecast_date date, target_ts timestamp_ntz, issued_at timestamp_ntz, model_version string, "
                   "predicted_m3 double, actual_m3 double, error_m3 double, abs_pct_error double")
ACCURACY_DAILY = ("forecast_date date, hours_scored bigint, mape double, wape double, bias_pct double, "
                  "max_abs_pct_error double")

# source name -> (schema, natural key, timestamp column that windows the table)
FEEDS = {
    "consumption": (CONSUMPTION, ["timestamp_local"], "timestamp_local"),
    "weather_obs": (WEATHER_OBS, ["timestamp_local"], "timestamp_local"),
    "weather_fcst": (WEATHER_FCST, ["forecast_issued_local", "timestamp_local"], "timestamp_local"),
    "calendar": (CALENDAR, ["date"], "date"),
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def with_series(ddl: str, series_keys: tuple[str, ...] | list[str]) -> str:
    """The schema with leading series columns that it does not already hold."""
    have = set(struct(ddl).fieldNames())
    return ", ".join([*[f"{k} string" for k in series_keys if k not in have], ddl])
