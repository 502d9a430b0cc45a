"""A spread of registered queries against DuckDB on the smallest tables (``check.py`` runs all of them)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
SAMPLE = ["upsert", "landing_plan", "lag_self_join", "win_rolling_7d", "win_interpolate", "agg_quantile_global",
          "dq_frozen_value", "dq_duplicate_key", "build_features", "metrics", "diebold_mariano", "conformal_interval",
          "daily_accuracy", "hinge_best", "acf", "score_forecast", "stream_hourly", "stream_gate"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    con = check.connect(SF)
    status, _, _, note = check.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert status == "ok", note


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 160


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_relative_level_has_both_levels(spark):
    con = check.connect(SF)
    status, n, _, note = check.compare(spark, con, "feat_relative_level", entry.queries()["feat_relative_level"],
                                       entry.oracle_sql()["feat_relative_level"], SF)
    got = entry.queries()["feat_relative_level"](spark, SF)
    assert status == "ok" and got.columns == ["series", "ts", "rel", "rel_year"], note
    assert got.where("rel IS NOT NULL AND rel_year IS NOT NULL").count() > n // 2
