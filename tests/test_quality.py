from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowgrid.config import Quality
from flowgrid.functions.timefns import hour_pos
from flowgrid.operators import quality as Q


@pytest.fixture(scope="module")
def bronze(raw):
    c = raw["consumption"].select(hour_pos("timestamp_local").alias("h"), F.col("demand_m3h").alias("demand"))
    c = c.withColumn("row_id", F.concat(F.lit("a"), F.col("h"))).withColumn("at", F.lit(1))
    return c.cache()



def first_hour(df):
    return df.agg(F.min("h")).first()[0]


def tag(df):
    return Q.tag(df, ["h"], "row_id", ["at"], ["h", "demand"], "demand", 0.0, 200000.0, 3).cache()


def counts(tagged):
    return {r["check_name"]: r["failed_rows"] for r in Q.row_results(tagged, "consumption").collect()}


def gate(raw_df, tagged):
    per = Q.completeness(raw_df, Q.clean_rows(tagged), [], "h", Quality())
    res = Q.row_results(tagged, "consumption").unionByName(Q.completeness_result(per, Quality()))
    return res.agg(Q.verdict(res)).first()[0]


def test_clean_batch_passes(bronze):
    t = tag(bronze)
    assert set(counts(t).values()) == {0}
    assert gate(bronze, t) is True
    assert Q.quarantine(t, "consumption").isEmpty()


def test_bad_rows_are_quarantined_not_blocking(bronze):
    h0 = first_hour(bronze)
    bad = bronze.withColumn("demand", F.when(F.col("h") < h0 + 3, -5.0).otherwise(F.col("demand")))
    twice = bad.where(F.col("h").isin(h0 + 10, h0 + 11)).withColumn("row_id", F.concat(F.lit("b"), F.col("h")))
    t = tag(bad.unionByName(twice))
    assert counts(t) == {"null_value": 0, "out_of_range": 3, "duplicate_key": 2, "frozen_value": 0}
    clean = Q.clean_rows(t)
    assert clean.count() == clean.select("h").distinct().count()
    assert gate(bad, t) is True


def test_missing_five_percent_blocks(bronze):
    """The batch still spans its days when the hours inside it are missing."""
    h0 = first_hour(bronze)
    part = bronze.where((F.col("h") < h0 + 100) | (F.col("h") >= h0 + 190))
    assert gate(part, tag(part)) is False


def test_stuck_meter(bronze):
    h0 = first_hour(bronze)
    stuck = bronze.withColumn("demand", F.when(F.col("h").between(h0 + 100, h0 + 103), 79737.3).otherwise(F.col("demand")))
    t = tag(stuck)
    assert counts(t)["frozen_value"] == 4
    assert Q.clean_rows(t).where("demand = 79737.3").isEmpty()
    two = bronze.withColumn("demand", F.when(F.col("h").between(h0 + 100, h0 + 101), 79737.3).otherwise(F.col("demand")))
    assert counts(tag(two))["frozen_value"] == 0


def test_newer_duplicate_wins(bronze):
    h0 = first_hour(bronze)
    newer = bronze.where(F.col("h") == h0).select("h", F.lit(999.0).alias("demand"), F.lit("0new").alias("row_id"),
                                                   F.lit(2).alias("at"))
    clean = Q.clean_rows(tag(bronze.unionByName(newer)))
    assert clean.where(F.col("h") == h0).first()["demand"] == 999.0


def test_hot_key_with_many_versions(spark):
    """A third of the batch may be versions of one key."""
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).cast("int").alias("h"), F.col("id").cast("double").alias("demand"),
        F.col("id").alias("row_id"))
    t = Q.tag(rows, ["h"], "row_id", [], ["h", "demand"], "demand", 0, 1e9, 3)
    assert t.where("reason = 'duplicate_key'").count() == 999
    assert t.where("reason IS NULL AND h = 0").first()["row_id"] == 999


def test_missing_vintage_blocks(inputs):
    fc = inputs["fcst"]
    day = fc.agg(F.max(F.floor(F.col("issued_h") / 24))).first()[0] + 1
    ok = Q.horizon_result(Q.horizon_coverage(fc, [], F.lit(day)), "d").first()
    gone = fc.where(F.floor(F.col("issued_h") / 24) != day - 1)
    bad = Q.horizon_result(Q.horizon_coverage(gone, [], F.lit(day)), "d").first()
    assert ok["passed"] and not bad["passed"] and "24 of 24" in bad["detail"]


def test_unknown_fault_raises(bronze):
    with pytest.raises(ValueError, match="unknown fault"):
        Q.inject_fault(bronze, "earthquake", "consumption")
    assert bronze.count() - Q.inject_fault(bronze, "meter_outage", "consumption").count() == 8
