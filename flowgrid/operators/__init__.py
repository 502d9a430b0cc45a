"""Distributed time-series operators. Every function takes and returns DataFrames and stays lazy."""
