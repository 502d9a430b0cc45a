from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowgrid.operators import decide as D
from flowgrid.operators import evaluate as E
from flowgrid.plans import landing as L

DAY = 20209  # 2025-05-01


@pytest.fixture(scope="module")
def log(spark):
    h = spark.range(24).select((F.col("id") + DAY * 24).cast("int").alias("h"))
    one = h.select("h", (F.col("h") - 20).alias("issued_h"), F.lit("1").alias("model_version"), F.lit(50.0).alias("predicted_m3"))
    two = h.select("h", (F.col("h") - 19).alias("issued_h"), F.lit("2").alias("model_version"), F.lit(110.0).alias("predicted_m3"))
    return one.unionByName(two)


def test_latest_issue_is_scored(spark, log):
    act = log.select("h").distinct().withColumn("demand", F.lit(100.0))
    hourly = E.reconcile(log, act, [])
    r = hourly.agg(F.count("*"), F.min("model_version"), F.max("model_version"), F.avg("abs_pct_error")).first()
    assert tuple(r) == (24, "2", "2", pytest.approx(10))
    daily = E.daily_accuracy(hourly, []).collect()
    assert len(daily) == 1 and daily[0]["bias_pct"] == pytest.approx(10) and daily[0]["hours_scored"] == 24


def test_zero_actual_has_no_percentage(spark, log):
    act = log.select("h").distinct().withColumn("demand", F.lit(0.0))
    r = E.daily_accuracy(E.reconcile(log, act, []), []).first()
    assert r["mape"] is None and r["wape"] is None


def fair(spark, through):
    h = spark.range(28 * 24).select((F.col("id") + 20000 * 24).cast("int").alias("h"))
    return D.fair_hours(h, F.lit(through).cast("int"), []).first()


def test_fair_window(spark):
    first = 20000 * 24
    enough = fair(spark, first + 15 * 24 - 1)
    assert enough["days"] == 13 and enough["comparable"]
    assert not fair(spark, first + 24 * 24 - 1)["comparable"]
    free = fair(spark, None)
    assert free["hours"] == 28 * 24 and free["comparable"]


@pytest.mark.parametrize("new,old,want", [(5.0, None, True), (20.0, None, False), (4.90, 5.00, True), (4.97, 5.00, False),
                                          (5.20, 5.00, False)])
def test_promotion_rules_agree(spark, new, old, want):
    df = spark.createDataFrame([(new, old)], "challenger double, champion double")
    got = D.promotion(df).first()
    assert got["promote"] is want and f"{new:.3f}" in got["reason"]


@pytest.mark.parametrize("mapes,base,want", [([4, 7, 7, 7], 5.0, True), ([7, 7, 4, 7], 5.0, False), ([7, 7], 5.0, False),
                                             ([1, 1, 1], None, True)])
def test_retrain(spark, mapes, base, want):
    df = spark.createDataFrame([("a", i, float(m)) for i, m in enumerate(mapes)], "k string, forecast_day int, mape double")
    assert D.needs_retrain(df, ["k"], F.lit(base).cast("double")).first()["retrain"] is want


def day(*d):
    return (date(*d) - date(1970, 1, 1)).days


@pytest.mark.parametrize("landed,history,want", [
    ([day(2026, 9, 19)], None, (day(2026, 9, 20), day(2026, 9, 22))), ([day(2026, 9, 21)], None, (day(2026, 9, 22), day(2026, 9, 22))),
    ([day(2026, 9, 22)], None, None), ([day(2026, 9, 23)], None, None), ([day(2026, 9, 20), day(2026, 9, 21)], None, (day(2026, 9, 22),) * 2),
    ([], None, None), ([], (day(2026, 1, 1), day(2026, 9, 19)), (day(2026, 1, 1), day(2026, 9, 19))),
    ([], (day(2026, 1, 1), day(2030, 1, 1)), (day(2026, 1, 1), day(2026, 9, 22))), ([day(2026, 1, 1)], (day(2026, 1, 1), day(2026, 9, 19)), None)])
def test_due_days(spark, landed, history, want):
    df = spark.createDataFrame([(d,) for d in landed], "high_water int")
    r = L.due_days(df, F.lit(day(2026, 9, 23)), history).first()
    assert (None if r["first_day"] is None else (r["first_day"], r["last_day"])) == want
    assert r["high_water"] == max(landed, default=None)


@pytest.mark.parametrize("latest,fresh", [(day(2026, 9, 22), True), (day(2026, 9, 21), False), (None, False)])
def test_freshness(spark, latest, fresh):
    from flowgrid.operators.quality import freshness

    one = spark.range(1).select(freshness(F.lit(latest).cast("int"), F.lit(day(2026, 9, 23)))).first()[0]
    assert one is fresh


def test_zone_column(spark):
    from flowgrid.functions.timefns import to_local

    r = spark.sql("SELECT timestamp_ntz'2026-09-22 21:30:00' AS t").select(to_local("t", "Asia/Dubai")).first()[0]
    assert r == datetime(2026, 9, 23, 1, 30)
