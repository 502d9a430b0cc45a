from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from flowgrid.operators import features as FE


def dpos(text):
    return (date.fromisoformat(text) - date(1970, 1, 1)).days


def hpos(text, hour):
    return dpos(text) * 24 + hour


@pytest.fixture(scope="module")
def built(spark, inputs):
    tgt = FE.targets(None, [], dpos("2025-04-01"), dpos("2025-05-12"), spark)
    df = FE.build_features(tgt, inputs["demand"], inputs["fcst"], inputs["calendar"], inputs["obs"], [])
    return df.toPandas().set_index("h").sort_index()


@pytest.fixture(scope="module")
def src(inputs):
    return {k: inputs[k].toPandas() for k in ("demand", "fcst", "obs")}


def test_shape_and_order(built):
    assert len(built) == 42 * 24 and built.index.is_unique
    assert list(built.columns) == FE.MODEL_COLUMNS and len(FE.FEATURES) == 43 and len(FE.FIRST_VERSION) == 37


def test_lags(built, src):
    y = src["demand"].set_index("h").demand
    h = hpos("2025-04-20", 8)
    assert built.lag_168h[h] == y[h - 168] and built.lag_48h[h] == y[h - 48]


def test_tomorrow_has_every_feature(built):
    day = built.loc[hpos("2025-05-12", 0):hpos("2025-05-12", 23)]
    assert len(day) == 24 and not day.isna().any().any()


def test_short_lag_raises(spark, inputs):
    with pytest.raises(ValueError, match="leak"):
        FE.level_features(inputs["demand"], inputs["demand"], [], min_lag_h=72)


def test_vintage_of_the_eve(built, src):
    h = hpos("2025-04-20", 15)
    f = src["fcst"]
    eve = f[(f.h == h) & (f.issued_h == hpos("2025-04-19", 6))].temperature.iloc[0]
    assert built.fc_temperature_c[h] == eve
    assert built.fc_cdd24_hour[h] == pytest.approx(max(eve - 24.4, 0))


def test_persistence(built, src):
    h = hpos("2025-04-20", 15)
    o, f = src["obs"], src["fcst"]
    assert built.obs_tmean_d2[h] == pytest.approx(o[o.h // 24 == dpos("2025-04-18")].temperature.mean())
    prev = f[(f.issued_h == hpos("2025-04-18", 6)) & (f.h // 24 == dpos("2025-04-19"))]
    assert built.fc_tmean_prev_day[h] == pytest.approx(prev.temperature.mean())


def test_calendar_flags(built):
    day = built.groupby(built.index // 24).first()
    eid = day.loc[dpos("2025-04-21")]
    assert eid.is_holiday == eid.is_day_off == eid.is_eid == 1
    assert day.is_eid.sum() == 1
    assert day.day_before_holiday[dpos("2025-04-20")] == 1 and day.day_after_holiday[dpos("2025-04-22")] == 1
    ev = day.loc[dpos("2025-04-23")]
    assert (ev.event_structural, ev.event_operational, ev.event_weather) == (1, 0, 0)
    assert list(day[day.is_ramadan == 1].ramadan_day) == [1, 2, 3]


def test_trend_index(built):
    h = hpos("2025-04-20", 6)
    assert built.t_days[h] == pytest.approx((h - hpos("2024-01-01", 0)) / 24)


def test_no_leakage(spark, inputs, built):
    """Changing anything after the issue time leaves the features of the target day as they were."""
    d0 = dpos("2025-04-20")
    wrong = inputs["demand"].withColumn("demand", F.when(F.col("h") >= (d0 - 1) * 24, 0.0).otherwise(F.col("demand")))
    late = inputs["fcst"].withColumn("temperature", F.when(F.col("issued_h") >= d0 * 24, -9.0).otherwise(F.col("temperature")))
    obs = inputs["obs"].withColumn("temperature", F.when(F.col("h") >= (d0 - 1) * 24, -9.0).otherwise(F.col("temperature")))
    tgt = FE.targets(None, [], d0, d0, spark)
    got = FE.build_features(tgt, wrong, late, inputs["calendar"], obs, []).toPandas().set_index("h").sort_index()
    want = built.loc[got.index]
    assert ((got - want).abs().fillna(0) < 1e-9).all().all()


def test_refresh_range(inputs):
    back = FE.refresh_range(inputs["demand"], None, backfill=True).first()
    daily = FE.refresh_range(inputs["demand"], None).first()
    assert back["first_day"] == dpos("2025-03-22") and back["last_day"] == dpos("2025-05-12")
    assert daily["first_day"] == dpos("2025-05-09") and daily["demand_from"] == dpos("2025-05-09") - 30
