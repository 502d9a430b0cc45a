"""End-to-end runs on the clean feed, and the table operations underneath."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowgrid import config
from flowgrid.config import Project
from flowgrid.operators import models as M
from flowgrid.plans import pipeline as P
from flowgrid.plans.registry import Registry
from flowgrid.sources import tables as T


def project(root, **kw):
    return Project(root=str(root), series_keys=("site_id",), history_start="2025-03-01", history_end="2025-05-07", **kw)


def test_config_environments():
    assert config.load("/x", "qa").history_start == "2024-09-15"
    with pytest.raises(ValueError, match="unknown environment"):
        config.load("/x", "moon")


def test_csv_window(spark, raw, tmp_path):
    for n, f in T.CSV_FILES.items():
        raw[n].coalesce(1).write.option("header", True).csv(str(tmp_path / f))
    schemas = {n: ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in raw[n].schema) for n in T.CSV_FILES}
    got = T.source_window(T.csv_feeds(spark, str(tmp_path), schemas), date(2025, 4, 20), date(2025, 4, 20),
                          datetime(2025, 4, 21, 5))
    assert got["consumption"].count() == 24
    f = got["weather_fcst"].agg(F.max("timestamp_local"), F.max("forecast_issued_local")).first()
    assert f[0] >= datetime(2025, 4, 22) and f[1] <= datetime(2025, 4, 21, 5)
    assert got["calendar"].agg(F.max("date")).first()[0] == date(2025, 4, 22)


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x", 1.0), (2, "x", 2.0), (3, "y", 3.0)], "k int, p string, v double")
    b = spark.createDataFrame([(2, "x", 20.0, "n"), (4, "z", 4.0, "n")], "k int, p string, v double, note string")
    assert T.upsert(spark, a, path, ["k"], "p")
    for _ in range(2):  # running it again changes nothing
        assert T.upsert(spark, b, path, ["k"], "p")
        known = T.struct_union(a.schema, b.schema)
        got = {r["k"]: (r["v"], r["note"]) for r in spark.read.schema(known).parquet(path).collect()}
        assert got == {1: (1.0, None), 2: (20.0, "n"), 3: (3.0, None), 4: (4.0, "n")}
    assert not T.upsert(spark, b.where("k > 99"), path, ["k"], "p")


def test_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS fg_gold LOCATION '{tmp_path}/gold'")
    T.ensure_database(spark, "fg_gold")
    for _ in range(2):
        T.ensure_table(spark, "fg_gold.features", "target_ts timestamp_ntz, lag_48h double")
    assert spark.catalog.tableExists("fg_gold.features")
    spark.sql("DROP DATABASE fg_gold CASCADE")


def test_pipeline_end_to_end(spark, raw, tmp_path):
    p = project(tmp_path)
    got = P.run_daily(spark, p, raw, datetime(2025, 5, 8, 9), "backfill")
    assert got["gate"] and got["features"] == (date(2025, 3, 22), date(2025, 5, 9))
    assert P.land(spark, p, raw, "backfill", datetime(2025, 5, 8, 9)) == "skipped"
    feats = spark.read.parquet(p.path("gold.demand_features"))
    assert feats.count() == 49 * 24 and T.duplicate_keys(feats, ["site_id", "target_ts"]).isEmpty()

    with pytest.raises(RuntimeError, match="champion"):
        P.forecast(spark, p, "r0")
    data = feats.withColumn("h", F.lit(0))
    reg = Registry(spark, p)
    model = M.fit("ridge_fourier", data.join(raw["consumption"].select(
        "site_id", F.col("timestamp_local").alias("target_ts"), F.col("demand_m3h").alias("y")), ["site_id", "target_ts"]),
        ["site_id"])
    v = reg.register(model, {"holdout_mape": "1.5"})
    assert reg.version("champion") is None
    reg.set_alias("champion", v)
    assert P.forecast(spark, p, "r1") == 1

    # a same-day run lands nothing; two missed days are caught up in one batch
    assert P.land(spark, p, raw, "daily", datetime(2025, 5, 8, 9)) == "up_to_date"
    got = P.run_daily(spark, p, raw, datetime(2025, 5, 10, 9))
    assert got["gate"] and got["days"] == 2
    log = spark.read.parquet(p.path("gold.demand_forecasts"))
    assert {str(r[0]): r[1] for r in log.groupBy("p_day").count().collect()} == {
        "2025-05-09": 24, "2025-05-10": 24, "2025-05-11": 24}
    assert log.where("hour(issued_at) = 5 AND datediff(target_ts, issued_at) = 1").count() == 72

    for _ in range(2):
        retrain, _reason = P.monitor(spark, p)
        acc = spark.read.parquet(p.path("monitoring.forecast_accuracy_daily"))
        assert [(str(r["forecast_date"]), r["hours_scored"]) for r in acc.collect()] == [("2025-05-09", 24)]
        assert retrain is False and acc.first()["mape"] < 5

    # a broken batch blocks and leaves silver as it was
    before = spark.read.parquet(p.path("silver.consumption")).count()
    got = P.run_daily(spark, p, raw, datetime(2025, 5, 11, 9), fault="missing_forecast")
    assert got["gate"] is False and "features" not in got
    assert spark.read.parquet(p.path("silver.consumption")).count() == before
    q = spark.read.parquet(p.path("monitoring.dq_results")).where("NOT passed AND severity = 'error'")
    assert [r["check_name"] for r in q.collect()] == ["forecast_horizon_coverage"]

    dev = Project(root=str(tmp_path / "copy"), series_keys=("site_id",))
    P.refresh(spark, p, dev, 10)
    days = spark.read.parquet(dev.path("silver.consumption")).select("p_day").distinct().count()
    assert days == 11


def test_the_last_of_many_versions_in_one_batch_survives(spark, tmp_path):
    from flowgrid.operators import quality

    rows = [(7, float(i), i) for i in range(14)]
    df = spark.createDataFrame(rows, "h int, v double, _row_id long").withColumn("_ingested_at", F.lit("2026-01-01").cast("timestamp"))
    kept = quality.clean_rows(quality.tag(df, ["h"], "_row_id", ["_ingested_at"], ["v"], "v", -1, 99)).collect()
    assert [r["v"] for r in kept] == [13.0]


def test_a_gate_killed_between_feeds_loses_nothing(spark, raw, tmp_path, monkeypatch):
    p = project(tmp_path)
    P.land(spark, p, raw, "backfill", datetime(2025, 5, 8, 9))
    P.ingest_bronze(spark, p)
    real, done = T.upsert, []

    def dies(spark, source, path, keys, by):
        if done:
            raise RuntimeError("killed")
        done.append(path)
        return real(spark, source, path, keys, by)

    monkeypatch.setattr(T, "upsert", dies)
    with pytest.raises(RuntimeError, match="killed"):
        P.quality_gate(spark, p, "r", date(2025, 5, 8))
    monkeypatch.setattr(T, "upsert", real)
    P.ingest_bronze(spark, p)  # nothing new
    assert P.quality_gate(spark, p, "r", date(2025, 5, 8))
    for name in ("consumption", "weather_obs", "weather_fcst", "calendar"):
        assert not P.read(spark, p, f"silver.{name}").isEmpty()
    assert P.pending(spark, p, "bronze", "silver").isEmpty()
    plan = P.of_batches(P.read(spark, p, "bronze.consumption"), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_batch_id" in plan.replace("isnotnull(_batch_id", "_batch_id") or "_batch_id" in plan.split("PartitionFilters")[1][:60]


def test_a_series_without_features_is_reported(spark):
    x = spark.createDataFrame([("a", datetime(2025, 5, 1, h)) for h in range(24)], "k string, target_ts timestamp_ntz")
    known = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = P.incomplete_days(x, ["k"], date(2025, 5, 1), date(2025, 5, 2), 24, known).collect()
    assert {(r["k"], str(r["day"]), r["rows"]) for r in got} == {
        ("a", "2025-05-02", 0), *(((k, f"2025-05-0{d}", 0)) for k in ("b", None) for d in (1, 2))}


def test_upsert_rejects_two_rows_of_one_key(spark, tmp_path):
    twice = spark.createDataFrame([(1, "2025-01-01", 1.0), (1, "2025-01-01", 2.0)], "k int, p string, v double")
    with pytest.raises(ValueError, match="several rows"):
        T.upsert(spark, twice, str(tmp_path / "t"), ["k"], "p")
