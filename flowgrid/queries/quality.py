"""Data-quality rules (inventory I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgrid.config import Quality
from flowgrid.functions.timefns import day_date, day_of_hour, hour_ts
from flowgrid.operators import explore as X
from flowgrid.operators import quality as Q
from flowgrid.operators import series
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.queries.series import NOTE
from flowgrid.queries.tables import tagged_readings
from flowgrid.sources import inputs as I

# 200 is the upper demand bound on the test data
LIMITS = Quality(demand_max=200.0)


def _rule(name: str):
    sql = f"SELECT series, {TS('h')} AS ts, row_id FROM v_tagged WHERE reason = '{name}'"

    @query(f"dq_{name}", sql)
    def rule(spark, sf):
        return out(tagged_readings(spark, sf).where(F.col("reason") == name).select("series", "h", "row_id"))
    return rule


for _name in ("null_value", "out_of_range", "duplicate_key"):
    _rule(_name)


@query("dq_frozen_value", f"""
WITH b AS (SELECT series, h, n, CASE WHEN n = lag(n) OVER w AND h - lag(h) OVER w = 1 THEN 0 ELSE 1 END AS brk
  FROM v_counts WINDOW w AS (PARTITION BY series ORDER BY h)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY h) AS run FROM b)
SELECT series, {TS('h')} AS ts, n FROM r QUALIFY count(*) OVER (PARTITION BY series, run) >= 3""")
def dq_frozen_value(spark, sf):
    return out(series.stuck(I.counts(spark, sf), ["series"], "h", "n", 3).where("is_stuck").drop("is_stuck"))


@query("dq_completeness", """
WITH s AS (SELECT min(h // 24) AS a, max(h // 24) AS b FROM v_readings)
SELECT series, (b - a + 1) * 24 AS expected, present, greatest((b - a + 1) * 24 - present, 0) AS missing,
  greatest((b - a + 1) * 24 - present, 0) <= greatest(3, (b - a + 1) * 24 * 0.02) AS passed
FROM (SELECT series, count(DISTINCT h) FILTER (reason IS NULL) AS present FROM v_tagged GROUP BY series), s""")
def dq_completeness(spark, sf):
    raw = I.readings(spark, sf)
    return Q.completeness(raw, Q.clean_rows(tagged_readings(spark, sf)), ["series"], "h", LIMITS)


@query("dq_horizon_coverage", f"""
SELECT {DT('t.day')} AS date, count(DISTINCT v.h) AS hours, greatest(24 - count(DISTINCT v.h), 0) AS missing,
  count(DISTINCT v.h) >= 24 AS passed
FROM (SELECT DISTINCT h // 24 AS day FROM v_ev) t
LEFT JOIN v_vint v ON v.h // 24 = t.day AND v.issued_h // 24 = t.day - 1 AND v.temperature BETWEEN 0 AND 50 GROUP BY ALL""")
def dq_horizon_coverage(spark, sf):
    fc = Q.tag(I.vintages(spark, sf), ["issued_h", "h"], "row_id", [], ["issued_h", "h", "temperature"],
               "temperature", 0.0, 50.0)
    clean = Q.clean_rows(fc).withColumn("day", day_of_hour("h")).where(
        day_of_hour("issued_h") == F.col("day") - 1)
    cover = Q.horizon_coverage(clean, ["day"], F.col("day"))
    days = I.events(spark, sf).select(day_of_hour("h").alias("day")).distinct()
    hours = F.coalesce("hours", F.lit(0)).cast("bigint")
    return out(days.join(cover, "day", "left").select(
        "day", hours.alias("hours"), F.greatest(F.lit(24) - hours, F.lit(0)).cast("bigint").alias("missing"),
        (hours >= 24).alias("passed")))


@query("dq_freshness", f"""
SELECT user_id, {DT('d')} AS latest, d >= today - 1 AS fresh, true AS setup_ok
FROM (SELECT user_id, max(h // 24) AS d FROM v_ev GROUP BY user_id), (SELECT max(h // 24) + 1 AS today FROM v_ev)""")
def dq_freshness(spark, sf):
    e = I.events(spark, sf)
    latest = e.groupBy("user_id").agg(F.max(day_of_hour("h")).alias("d"))
    one = e.agg((F.max(day_of_hour("h")) + 1).alias("today"))
    df = series.attach(latest, one, [])
    return df.select("user_id", day_date("d").alias("latest"), Q.freshness(F.col("d"), F.col("today")).alias("fresh"),
                     Q.freshness(F.col("d"), F.col("today"), True).alias("setup_ok"))


RULES = "(SELECT unnest(['null_value', 'out_of_range', 'duplicate_key', 'frozen_value']) AS check_name)"


@query("dq_check_results", f"""
WITH s AS (SELECT min(h // 24) AS a, max(h // 24) AS b FROM v_readings),
c AS (SELECT greatest((b - a + 1) * 24 - present, 0) AS missing, (b - a + 1) * 24 AS expected FROM
  (SELECT series, count(DISTINCT h) FILTER (reason IS NULL) AS present FROM v_tagged GROUP BY series), s)
SELECT r.check_name, 'consumption' AS table_name, 'warn' AS severity, count(t.row_id) = 0 AS passed, count(t.row_id) AS failed_rows,
  CASE WHEN count(t.row_id) = 0 THEN 'ok' ELSE count(t.row_id) || ' rows rejected' END AS detail
FROM {RULES} r LEFT JOIN v_tagged t ON t.reason = r.check_name GROUP BY ALL
UNION ALL SELECT 'hourly_completeness', 'consumption', 'error', bool_and(missing <= greatest(3, expected * 0.02)),
  CAST(sum(missing) AS BIGINT), CAST(sum(missing) AS BIGINT) || ' of ' || CAST(sum(expected) AS BIGINT) || ' hours lack a clean reading: ' ||
  format('{{:.2f}}', 100.0 * sum(missing) / sum(expected)) || '%; allowed 2% or 3 hours' FROM c""")
def dq_check_results(spark, sf):
    tagged = tagged_readings(spark, sf)
    per = Q.completeness(I.readings(spark, sf), Q.clean_rows(tagged), ["series"], "h", LIMITS)
    return Q.row_results(tagged, "consumption").unionByName(Q.completeness_result(per, LIMITS))


@query("dq_quarantine", "SELECT 'consumption' AS table_name, reason, row_id FROM v_tagged WHERE reason IS NOT NULL")
def dq_quarantine(spark, sf):
    q = Q.quarantine(tagged_readings(spark, sf), "consumption")
    return q.select("table_name", "reason", F.get_json_object("record_json", "$.row_id").cast("bigint").alias("row_id"))


@query("dq_gate", """
WITH s AS (SELECT min(h // 24) AS a, max(h // 24) AS b FROM v_readings),
c AS (SELECT greatest((b - a + 1) * 24 - present, 0) <= greatest(3, (b - a + 1) * 24 * 0.02) AS ok FROM
  (SELECT series, count(DISTINCT h) FILTER (reason IS NULL) AS present FROM v_tagged GROUP BY series), s)
SELECT (SELECT bool_and(ok) FROM c) AS passed, (SELECT count(*) FROM v_tagged WHERE reason IS NULL) AS clean_rows,
  (SELECT count(*) FROM v_tagged WHERE reason IS NOT NULL) AS bad_rows""")
def dq_gate(spark, sf):
    tagged = tagged_readings(spark, sf)
    per = Q.completeness(I.readings(spark, sf), Q.clean_rows(tagged), ["series"], "h", LIMITS)
    results = Q.row_results(tagged, "consumption").unionByName(Q.completeness_result(per, LIMITS))
    counts = tagged.agg(F.count(F.when(F.col("reason").isNull(), 1)).alias("clean_rows"),
                        F.count("reason").alias("bad_rows"))
    return series.attach(counts, results.agg(Q.verdict(results).alias("passed")), [])


@query("dq_frozen_eda", f"""
WITH b AS (SELECT series, h, n, CASE WHEN n = lag(n) OVER w THEN 0 ELSE 1 END AS brk
  FROM v_counts WINDOW w AS (PARTITION BY series ORDER BY h)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY h) AS run FROM b)
SELECT series, {TS('h')} AS ts, n, count(*) OVER (PARTITION BY series, run) AS run_len FROM r
QUALIFY count(*) OVER (PARTITION BY series, run) >= 3""")
def dq_frozen_eda(spark, sf):
    return out(X.frozen_rows(I.counts(spark, sf), ["series"], "n").select("series", "h", "n", "run_len"))


@query("dq_gap_runs", """
WITH g AS (SELECT g.series, g.h, d.demand IS NULL AS miss FROM v_grid g LEFT JOIN v_demand d ON d.series = g.series AND d.h = g.h),
b AS (SELECT *, CASE WHEN miss = lag(miss) OVER (PARTITION BY series ORDER BY h) THEN 0 ELSE 1 END AS brk FROM g),
r AS (SELECT *, sum(brk) OVER (PARTITION BY series ORDER BY h) AS run FROM b)
SELECT series, run_len, count(*) AS gaps FROM (SELECT series, run, count(*) AS run_len FROM r WHERE miss GROUP BY ALL)
GROUP BY ALL""")
def dq_gap_runs(spark, sf):
    return X.gap_runs(I.demand(spark, sf), ["series"])


def _cover_sql(name: str, view: str, pos: str, ts: str, columns: int) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS rows, {columns} AS columns, {ts.format(f'min({pos})')} AS start,
      {ts.format(f'max({pos})')} AS end, CAST(max({pos}) - min({pos}) + 1 AS BIGINT) AS expected_rows,
      CAST(max({pos}) - min({pos}) + 1 - count(DISTINCT {pos}) AS BIGINT) AS missing,
      count(*) - count(DISTINCT {pos}) AS duplicates FROM {view}"""


@query("dq_coverage_overview", " UNION ALL ".join([
    _cover_sql("demand", "v_readings", "h", "make_timestamp(CAST({0} AS BIGINT) * 3600000000)", 4),
    _cover_sql("weather_obs", "v_obs", "h", "make_timestamp(CAST({0} AS BIGINT) * 3600000000)", 4),
    _cover_sql("weather_fcst", "v_vint", "h", "make_timestamp(CAST({0} AS BIGINT) * 3600000000)", 6),
    _cover_sql("calendar", "v_cal", "day", "CAST((DATE '1970-01-01' + CAST({0} AS INTEGER)) AS TIMESTAMP)", 10)]))
def dq_coverage_overview(spark, sf):
    parts = [X.coverage(I.readings(spark, sf), "demand", "h", hour_ts),
             X.coverage(I.weather_obs(spark, sf), "weather_obs", "h", hour_ts),
             X.coverage(I.vintages(spark, sf), "weather_fcst", "h", hour_ts),
             X.coverage(I.calendar(spark, sf), "calendar", "day", day_date)]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@query("dq_rule_vs_note", f"""
SELECT note, count(*) AS n, count(*) FILTER (reason = 'null_value') AS null_value,
  count(*) FILTER (reason = 'out_of_range') AS out_of_range, count(*) FILTER (reason = 'duplicate_key') AS duplicate_key
FROM (SELECT {NOTE} AS note, reason FROM v_tagged) GROUP BY note""")
def dq_rule_vs_note(spark, sf):
    t = tagged_readings(spark, sf)
    note = F.when(F.col("demand").isNull(), "telemetry gap").when(F.col("demand") > 200, "spike").otherwise("ok")
    return t.groupBy(note.alias("note")).agg(F.count("*").alias("n"), *[
        F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in ("null_value", "out_of_range", "duplicate_key")])


@query("gate_silver", """
WITH m AS (SELECT (min(h // 24) + max(h // 24)) // 2 AS mid FROM v_readings),
c AS (SELECT h // 24 <= mid AS early, count(*) AS n FROM v_tagged, m WHERE reason IS NULL GROUP BY ALL)
SELECT 1 AS step, true AS written, (SELECT n FROM c WHERE early) AS silver_rows
UNION ALL SELECT 2, false, (SELECT n FROM c WHERE early) UNION ALL SELECT 3, true, (SELECT sum(n)::BIGINT FROM c)""")
def gate_silver(spark, sf):
    """Silver after three batches: the first half of the days is accepted; the second, with an outage of eight hours, is refused
    by the completeness rule and leaves the table unchanged; sent again whole, it is accepted under a rule for sparse meters."""
    from dataclasses import replace

    from flowgrid.plans import pipeline
    from flowgrid.session import shared_folder

    path = f"{shared_folder(spark, 'gate')}/silver"
    raw = I.readings(spark, sf).withColumn("p_day", day_of_hour("h").cast("string"))
    ends = raw.agg(F.min(day_of_hour("h")), F.max(day_of_hour("h"))).first()
    early = day_of_hour("h") <= (ends[0] + ends[1]) // 2
    tagged = tagged_readings(spark, sf).withColumn("p_day", day_of_hour("h").cast("string"))
    sparse, strict = replace(LIMITS, max_missing_pct=100.0), replace(LIMITS, max_missing_pct=0.0)
    rows = []
    for step, (part, limits) in enumerate(((early, sparse), (~early, strict), (~early, sparse)), 1):
        fault = "meter_outage" if limits is strict else "none"
        sent, clean = (Q.inject_fault(x.where(part), fault, "consumption") for x in (raw, Q.clean_rows(tagged)))
        per = Q.completeness(sent, clean, ["series"], "h", limits)
        written = pipeline.gated_write(spark, clean, Q.completeness_result(per, limits), path, ["row_id"], "p_day")
        rows.append((step, written, spark.read.parquet(path).count()))
    return spark.createDataFrame(rows, "step int, written boolean, silver_rows bigint")
