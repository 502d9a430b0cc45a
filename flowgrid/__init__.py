"""Spark-native lakehouse for hourly metering series: quality gate, features, forecasts, monitoring."""

__version__ = "0.1.0"
