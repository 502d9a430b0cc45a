"""Scans, sources, ingestion, table maintenance (inventory A), projections and predicates (B), set operations (G)."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from flowgrid.functions import scalars as S
from flowgrid.functions.timefns import day_date, day_of_hour, hour_ts
from flowgrid.operators import explore, features, quality
from flowgrid.queries.base import DT, R, TS, out, query
from flowgrid.session import shared_folder
from flowgrid.sources import inputs as I
from flowgrid.sources import tables as T


@query("scan_filtered", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_discount >= 0.05""")
def scan_filtered(spark, sf):
    return T.scan(spark, f"{sf}/lineitem.parquet",
                  "l_shipdate >= timestamp_ntz'1997-01-01' AND l_shipdate < timestamp_ntz'1998-01-01' "
                  "AND l_discount >= 0.05").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")


@query("source_window", f"""
SELECT 'consumption' AS feed, count(*) AS n, min({TS('h')}) AS first_ts, max({TS('h')}) AS last_ts FROM v_readings
  WHERE {TS('h')} >= TIMESTAMP '2024-01-08' AND {TS('h')} < TIMESTAMP '2024-01-15'
UNION ALL SELECT 'weather_obs', count(*), min({TS('h')}), max({TS('h')}) FROM v_obs
  WHERE {TS('h')} >= TIMESTAMP '2024-01-08' AND {TS('h')} < TIMESTAMP '2024-01-15'
UNION ALL SELECT 'weather_fcst', count(*), min({TS('h')}), max({TS('h')}) FROM v_vint
  WHERE {TS('h')} >= TIMESTAMP '2024-01-08' AND {TS('h')} < TIMESTAMP '2024-01-17'
    AND {TS('issued_h')} <= TIMESTAMP '2024-01-15 05:00:00'
UNION ALL SELECT 'calendar', count(*), min(CAST(date AS TIMESTAMP)), max(CAST(date AS TIMESTAMP)) FROM v_cal
  WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-17'""")
def source_window(spark, sf):
    got = T.source_window(I.feeds(spark, sf), date(2024, 1, 8), date(2024, 1, 14), datetime(2024, 1, 15, 5))
    parts = []
    for name, df in got.items():
        c = F.col("date").cast("timestamp_ntz") if name == "calendar" else F.col("timestamp_local")
        parts.append(df.agg(F.lit(name).alias("feed"), F.count("*").alias("n"), F.min(c).alias("first_ts"),
                            F.max(c).alias("last_ts")))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@query("high_water_mark", f"""
SELECT series, {DT('max(d)')} AS high_water FROM (
  SELECT series, max(h // 24) AS d FROM v_readings GROUP BY series
  UNION ALL SELECT series, max(h // 24) FROM v_tagged WHERE reason IS NULL GROUP BY series) GROUP BY series""")
def high_water_mark(spark, sf):
    tagged = tagged_readings(spark, sf)
    hw = T.high_water([I.readings(spark, sf), quality.clean_rows(tagged)], day_of_hour("h"), ["series"])
    return hw.select("series", day_date("high_water").alias("high_water"))


def tagged_readings(spark, sf):
    """The readings with the rule that rejects each row; 200 is the upper bound on this data."""
    return quality.tag(I.readings(spark, sf), ["series", "h"], "row_id", [], ["h", "demand"], "demand", 0.0, 200.0, 3)


@query("landing_plan", f"""
SELECT user_id, {DT('day')} AS date FROM (
  SELECT user_id, unnest(generate_series(hw + 1, today - 1)) AS day FROM
    (SELECT user_id, max(h // 24) AS hw FROM v_ev GROUP BY user_id),
    (SELECT max(h // 24) + 3 AS today FROM v_ev))""")
def landing_plan(spark, sf):
    from flowgrid.plans.landing import missing_days

    e = I.events(spark, sf)
    hw = T.high_water([e], day_of_hour("h"), ["user_id"])
    today = e.agg((F.max(day_of_hour("h")) + 3).alias("t")).select("t").scalar()
    return out(missing_days(hw, ["user_id"], today))


@query("bronze_ingest", """
SELECT event_id, strftime(make_timestamp(h * 3600000000), '%Y%m%d') AS _batch_id, value,
  TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM v_ev
WHERE h // 24 NOT IN (SELECT h // 24 FROM v_ev WHERE h // 24 <= (SELECT max(h // 24) - 3 FROM v_ev))""")
def bronze_ingest(spark, sf):
    landing = I.events(spark, sf).select("event_id", day_of_hour("h").alias("day"), "value")
    landing = landing.withColumn("_batch_id", F.date_format(day_date("day"), "yyyyMMdd"))
    last = landing.agg((F.max("day") - 3).alias("d")).select("d").scalar()
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return T.new_batches(landing, landing.where(F.col("day") <= last), stamp).select(
        "event_id", "_batch_id", "value", "_ingested_at")


@query("anti_join_batch", """
SELECT h // 24 AS batch, count(*) AS n FROM v_ev
WHERE h // 24 NOT IN (SELECT h // 24 FROM v_ev WHERE series = 'view' AND value > 250) GROUP BY ALL""")
def anti_join_batch(spark, sf):
    e = I.events(spark, sf).withColumn("batch", day_of_hour("h").cast("bigint"))
    seen = e.where((F.col("series") == "view") & (F.col("value") > 250)).select("batch").distinct()
    return e.join(seen, "batch", "left_anti").groupBy("batch").agg(F.count("*").alias("n"))


UPSERT_SRC = """SELECT series, h + k AS h, demand * 2 AS demand, 'corrected' AS note
    FROM v_demand, (SELECT 0 AS k UNION ALL SELECT 24) WHERE h // 24 = (SELECT max(h // 24) FROM v_demand)"""


@query("upsert", f"""
SELECT series, {TS('h')} AS ts, demand, note FROM (
  SELECT series, h, demand, NULL AS note FROM v_demand d
  WHERE NOT EXISTS (SELECT 1 FROM ({UPSERT_SRC}) s WHERE s.series = d.series AND s.h = d.h)
  UNION ALL SELECT * FROM ({UPSERT_SRC}))""")
def upsert(spark, sf):
    d = I.demand(spark, sf)
    last = d.agg(F.max(day_of_hour("h")).alias("d")).select("d").scalar()
    src = d.where(day_of_hour("h") == last).withColumn("_k", F.explode(F.array(F.lit(0), F.lit(24))))
    src = src.select("series", (F.col("h") + F.col("_k")).alias("h"), (F.col("demand") * 2).alias("demand"),
                     F.lit("corrected").alias("note"))
    return out(T.merged(d, src, ["series", "h"]).select("series", "h", "demand", "note"))


@query("window_copy", """
SELECT event_id, ts, value FROM events
WHERE ts >= (SELECT date_trunc('day', max(ts)) - INTERVAL 7 DAY FROM events)""")
def window_copy(spark, sf):
    e = I.table(spark, sf, "events")
    return T.copy_window(e, "ts", e.agg(F.max("ts").alias("max_ts")), 7).select("event_id", "ts", "value")


@query("inject_fault", f"""
SELECT series, {TS('h')} AS ts, demand FROM v_demand
WHERE NOT (h >= (SELECT max(h // 24) FROM v_demand) * 24 + 6 AND h < (SELECT max(h // 24) FROM v_demand) * 24 + 14)""")
def inject_fault(spark, sf):
    return out(quality.inject_fault(I.demand(spark, sf), "meter_outage", "consumption"))


@query("incremental_watermark", f"""
SELECT row_id, {TS('h')} AS ts, demand FROM v_readings
WHERE h // 24 > (SELECT max(h // 24) FROM v_readings WHERE h // 24 <= 19742)""")
def incremental_watermark(spark, sf):
    bronze = I.readings(spark, sf).withColumn("_ingested_at", day_of_hour("h"))
    silver = bronze.where(F.col("_ingested_at") <= 19742)
    return out(T.watermark_slice(bronze, silver).select("row_id", "h", "demand"))


@query("issue_day", f"SELECT series, {DT('max(h // 24) + 1')} AS today FROM v_demand GROUP BY series")
def issue_day(spark, sf):
    from flowgrid.plans.landing import issue_day as today

    return today(I.demand(spark, sf), ["series"]).select("series", day_date("today").alias("today"))


@query("duplicate_keys", f"""
SELECT series, {TS('h')} AS ts, count(*) AS n FROM v_readings GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return out(T.duplicate_keys(I.readings(spark, sf), ["series", "h"]))


@query("append_lineage", f"""
WITH m AS (SELECT (min(h // 24) + max(h // 24)) // 2 AS mid, max(h // 24) AS last FROM v_readings)
SELECT strftime({DT('CASE WHEN h // 24 <= mid THEN mid ELSE last END')}, '%Y%m%d') || '-00000001' AS _batch_id, count(*) AS n,
  count(DISTINCT series) AS sites, true AS stamped FROM v_readings, m GROUP BY ALL""")
def append_lineage(spark, sf):
    """Two deliveries appended to a stored table, the second one sent twice; each batch is named after its last day and is kept
    once."""
    path = f"{shared_folder(spark, 'lineage')}/readings"
    rows = I.readings(spark, sf).withColumn("_day", day_of_hour("h"))
    first, last = rows.agg(F.min("_day"), F.max("_day")).first()
    mid = (first + last) // 2
    for until, part in ((mid, F.col("_day") <= mid), (last, F.col("_day") > mid), (last, F.col("_day") > mid)):
        batch = T.with_lineage(rows.where(part), f"{date(1970, 1, 1) + timedelta(days=until):%Y%m%d}-00000001")
        if T.exists(spark, path):
            batch = batch.join(F.broadcast(spark.read.parquet(path).select("_batch_id").distinct()), "_batch_id", "left_anti")  # a row for each batch
        T.append(batch, path)
    stored = spark.read.parquet(path)
    stamped = F.min(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in stored.columns if c.startswith("_")]).cast("int")) == 1
    return stored.groupBy("_batch_id").agg(F.count("*").alias("n"), F.count_distinct("series").alias("sites"), stamped.alias("stamped"))


@query("ensure_tables", """
SELECT 'consumption' AS name, count(*) AS n, count(DISTINCT series) AS places, true AS kept FROM v_readings
UNION ALL SELECT 'weather_obs', count(*), 1, true FROM v_obs""")
def ensure_tables(spark, sf):
    """A database and the tables of two feeds, declared, filled, and declared again: what is stored stays."""
    root = shared_folder(spark, "database")
    db = f"flowgrid_{root.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    feeds, res = I.feeds(spark, sf), None
    for name, place in (("consumption", "site_id"), ("weather_obs", "location")):
        rows = feeds[name]
        for turn in range(2):
            T.ensure_database(spark, db)
            T.ensure_table(spark, f"{db}.{name}", ", ".join(f"{c} {t}" for c, t in rows.dtypes))
            if not turn:
                rows.write.insertInto(f"{db}.{name}")
        one = spark.table(f"{db}.{name}").agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.count_distinct(place).alias("places"))
        one = one.withColumn("kept", F.lit(spark.catalog.tableExists(f"{db}.{name}")))
        res = one if res is None else res.unionByName(one)
    return res


# ---- B ---------------------------------------------------------------------------------------------------------
@query("proj_rename", f"SELECT series AS site_id, {TS('h')} AS target_ts, demand AS actual_m3 FROM v_demand")
def proj_rename(spark, sf):
    return I.demand(spark, sf).select(F.col("series").alias("site_id"), hour_ts("h").alias("target_ts"),
                                      F.col("demand").alias("actual_m3"))


@query("pred_any_null", "SELECT row_id FROM v_readings WHERE h IS NULL OR demand IS NULL")
def pred_any_null(spark, sf):
    return I.readings(spark, sf).where(S.any_null(["h", "demand"])).select("row_id")


@query("pred_out_of_range", "SELECT row_id, demand FROM v_readings WHERE demand < 1 OR demand > 200")
def pred_out_of_range(spark, sf):
    return I.readings(spark, sf).where(S.outside("demand", 1, 200)).select("row_id", "demand")


@query("split_good_bad", """
SELECT reason, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS id_sum FROM (
  SELECT row_id, CASE WHEN demand IS NULL THEN 'null_value' WHEN demand < 0 OR demand > 200 THEN 'out_of_range' END AS reason
  FROM v_readings) GROUP BY reason""")
def split_good_bad(spark, sf):
    df = I.readings(spark, sf).withColumn("reason", quality.early_reason(["h", "demand"], "demand", 0, 200))
    return df.groupBy("reason").agg(F.count("*").alias("n"), F.sum("row_id").alias("id_sum"))


@query("pred_day_range", """
SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def pred_day_range(spark, sf):
    e = I.table(spark, sf, "events")
    return e.where(T.ts_range("ts", datetime(2024, 1, 10), datetime(2024, 1, 13))).select("event_id", "ts")


DAY_TYPE = """CASE WHEN is_public_holiday THEN 'public holiday' WHEN is_ramadan THEN 'Ramadan'
    WHEN is_weekend THEN 'weekend' ELSE 'weekday' END"""
EID_TYPE = """CASE WHEN coalesce(holiday_name LIKE '%Eid%', false) THEN 'Eid' WHEN is_public_holiday THEN 'other holiday'
    WHEN is_ramadan THEN 'Ramadan' WHEN is_weekend THEN 'weekend' ELSE 'weekday' END"""
SEASON = """CASE WHEN month(date) IN (5, 6, 7, 8, 9) THEN 'summer' WHEN month(date) IN (12, 1, 2) THEN 'winter'
    ELSE 'shoulder' END"""


@query("case_day_type", f"SELECT o_orderkey, {DAY_TYPE} AS day_type, {EID_TYPE} AS eid_type, {SEASON} AS season FROM v_oday")
def case_day_type(spark, sf):
    return I.order_days(spark, sf).select(
        "o_orderkey", explore.day_type().alias("day_type"), explore.day_type(True).alias("eid_type"),
        explore.season(F.month("date")).alias("season"))


@query("clip_lower", f"""
SELECT row_id, {R('CASE WHEN demand IS NOT NULL THEN greatest(demand - 24.4, 0) END')} AS cooling,
  {R('CASE WHEN demand IS NOT NULL THEN greatest(12 - demand, 0) END')} AS heating FROM v_readings""")
def clip_lower(spark, sf):
    return out(I.readings(spark, sf).select("row_id", S.above("demand", 24.4).alias("cooling"),
                                            S.below("demand", 12).alias("heating")))


@query("null_default", """
SELECT event_id, coalesce(holiday_name, '') AS holiday_name, coalesce(day_event, 'none') AS day_event,
  CAST(coalesce(ramadan_day, 0) AS INTEGER) AS ramadan_day FROM v_eday""")
def null_default(spark, sf):
    return I.event_days(spark, sf).select(
        "event_id", F.coalesce("holiday_name", F.lit("")).alias("holiday_name"),
        F.coalesce("day_event", F.lit("none")).alias("day_event"), F.coalesce("ramadan_day", F.lit(0)).alias("ramadan_day"))


@query("membership_flag", """
SELECT c.o_orderkey, CAST(c.is_public_holiday AS INTEGER) AS is_holiday,
  CAST(coalesce(n.is_public_holiday, false) AS INTEGER) AS day_before, CAST(coalesce(p.is_public_holiday, false) AS INTEGER) AS day_after
FROM v_oday c LEFT JOIN v_lcal n ON n.day = c.day + 1 LEFT JOIN v_lcal p ON p.day = c.day - 1""")
def membership_flag(spark, sf):
    t = features.calendar_table(I.long_calendar(spark, sf))
    return I.order_days(spark, sf).select("o_orderkey", "day").join(F.broadcast(t), "day").select(  # a row per day
        "o_orderkey", F.col("is_holiday").cast("int"), F.col("day_before_holiday").cast("int").alias("day_before"),
        F.col("day_after_holiday").cast("int").alias("day_after"))


@query("bin_numeric", """
SELECT bin, count(*) AS n FROM (SELECT CAST(ceil((demand - 0) / 20.0) - 1 AS INTEGER) AS bin FROM v_readings
  WHERE demand IS NOT NULL) GROUP BY bin""")
def bin_numeric(spark, sf):
    df = I.readings(spark, sf).where(F.col("demand").isNotNull())
    return df.groupBy(S.bin_right("demand", 0, 20).alias("bin")).agg(F.count("*").alias("n"))


# ---- G ---------------------------------------------------------------------------------------------------------
@query("union_all", """
SELECT table_name, reason, count(*) AS n FROM (
  SELECT 'consumption' AS table_name, reason FROM v_tagged WHERE reason IS NOT NULL
  UNION ALL SELECT 'weather_fcst', CASE WHEN temperature > 50 THEN 'out_of_range' ELSE 'duplicate_key' END FROM (
    SELECT temperature, CASE WHEN temperature <= 50 THEN row_number() OVER
      (PARTITION BY issued_h, h, temperature <= 50 ORDER BY row_id DESC) END AS rn FROM v_vint)
    WHERE temperature > 50 OR rn > 1) GROUP BY ALL""")
def union_all(spark, sf):
    fc = quality.tag(I.vintages(spark, sf), ["issued_h", "h"], "row_id", [], ["issued_h", "h", "temperature"],
                     "temperature", 0.0, 50.0)
    parts = [quality.quarantine(tagged_readings(spark, sf), "consumption"), quality.quarantine(fc, "weather_fcst")]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("table_name", "reason").agg(F.count("*").alias("n"))


@query("distinct_keys", f"SELECT DISTINCT series, {TS('h')} AS ts FROM v_readings")
def distinct_keys(spark, sf):
    return out(I.readings(spark, sf).select("series", "h").dropDuplicates(["series", "h"]))


# ---- F ---------------------------------------------------------------------------------------------------------
@query("sort_keys", f"SELECT series, {TS('h')} AS ts, demand FROM v_demand ORDER BY series, ts")
def sort_keys(spark, sf):
    return out(I.demand(spark, sf)).orderBy("series", "ts")


@query("head_sample", f"""
SELECT series, {TS('h')} AS ts, demand FROM v_demand WHERE h % 10 = 3 ORDER BY h, series LIMIT 20""")
def head_sample(spark, sf):
    """Every tenth hour, the first 20 rows of it: a sample that comes out the same each time."""
    return out(I.demand(spark, sf).where(F.col("h") % 10 == 3).orderBy("h", "series").limit(20))


# ---- H ---------------------------------------------------------------------------------------------------------
@query("fn_time", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(ts AS DATE) + 2 AS day_plus_2,
  round(epoch_us(date_trunc('second', ts) - TIMESTAMP '2024-01-01') / 86400000000.0 + 3.3e-9::DOUBLE, 6) AS t_days,
  ts + INTERVAL 4 HOUR AS local_ts, strftime(ts, '%Y%m%d') AS day_key FROM events""")
def fn_time(spark, sf):
    from flowgrid.functions.timefns import fractional_days, to_local

    return out(I.table(spark, sf, "events").select(
        "event_id", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"), F.month("ts").alias("month"),
        F.dayofyear("ts").alias("doy"), F.date_add(F.to_date("ts"), 2).alias("day_plus_2"),
        fractional_days("ts", "2024-01-01").alias("t_days"), to_local("ts", "Asia/Dubai").alias("local_ts"),
        F.date_format("ts", "yyyyMMdd").alias("day_key")))


@query("fn_fourier", f"""
SELECT event_id, {R('sin(2 * pi() * hour(ts) / 24)')} AS hour_sin1, {R('cos(2 * pi() * 2 * hour(ts) / 24)')} AS hour_cos2,
  {R('sin(2 * pi() * (isodow(ts) - 1) / 7)')} AS dow_sin, {R('cos(2 * pi() * dayofyear(ts) / 365.25)')} AS doy_cos FROM events""")
def fn_fourier(spark, sf):
    return out(I.table(spark, sf, "events").select(
        "event_id", S.fourier(F.hour("ts"), 24)[0].alias("hour_sin1"), S.fourier(F.hour("ts"), 24, 2)[1].alias("hour_cos2"),
        S.fourier(F.weekday("ts"), 7)[0].alias("dow_sin"), S.fourier(F.dayofyear("ts"), 365.25)[1].alias("doy_cos")))


@query("fn_string_json", """
SELECT event_id, coalesce(holiday_name LIKE '%Eid%', false) AS is_eid, (holiday_name IS NULL) AS null_in_json FROM v_eday""")
def fn_string_json(spark, sf):
    rows = I.event_days(spark, sf)
    js = F.to_json(F.struct("day", "holiday_name"), {"ignoreNullFields": "false"})
    return rows.select("event_id", F.coalesce(F.col("holiday_name").contains("Eid"), F.lit(False)).alias("is_eid"),
                      js.contains('"holiday_name":null').alias("null_in_json"))


@query("fn_conditional", f"""
SELECT row_id, {R('CASE WHEN demand > 0 THEN abs(50 - demand) / demand * 100 END')} AS ape,
  {R('coalesce(demand, 0)')} AS filled, {R('100 / nullif(floor(demand), 0)')} AS safe_ratio FROM v_readings""")
def fn_conditional(spark, sf):
    return out(I.readings(spark, sf).select(
        "row_id", S.pct_error(F.lit(50.0), "demand").alias("ape"), F.coalesce("demand", F.lit(0.0)).alias("filled"),
        S.ratio(F.lit(100.0), F.floor("demand")).alias("safe_ratio")))


# ---- table maintenance through storage -------------------------------------------------------------------------
ORDERS_CSV = "o_orderkey bigint, o_orderdate timestamp_ntz, o_totalprice double"


@query("source_csv", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-06-01'""")
def source_csv(spark, sf):
    path = shared_folder(spark, "csv")
    I.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").write.option("header", True).csv(path)
    df = spark.read.schema(ORDERS_CSV).option("header", True).csv(path)
    return df.where(T.ts_range("o_orderdate", datetime(1996, 3, 1), datetime(1996, 6, 1)))


@query("overwrite_table", "SELECT series, count(*) AS n FROM v_demand GROUP BY series")
def overwrite_table(spark, sf):
    path = shared_folder(spark, "overwrite")
    T.overwrite(I.readings(spark, sf), path)
    T.overwrite(I.demand(spark, sf), path)
    return spark.read.parquet(path).groupBy("series").agg(F.count("*").alias("n"))


@query("upsert_stored", f"""
SELECT series, {TS('h')} AS ts, demand, note FROM (
  SELECT series, h, demand, NULL AS note FROM v_demand d
  WHERE NOT EXISTS (SELECT 1 FROM ({UPSERT_SRC}) s WHERE s.series = d.series AND s.h = d.h)
  UNION ALL SELECT * FROM ({UPSERT_SRC}))""")
def upsert_stored(spark, sf):
    path = shared_folder(spark, "upsert")
    with_day = lambda df: df.withColumn("p_day", day_date(day_of_hour("h")).cast("string"))
    T.upsert(spark, with_day(I.demand(spark, sf)), path, ["series", "h"], "p_day")
    stored = spark.read.parquet(path)
    last = stored.where(F.col("p_day") == stored.agg(F.max("p_day").alias("m")).select("m").scalar())
    twice = last.withColumn("_k", F.explode(F.array(F.lit(0), F.lit(24)))).select(
        "series", (F.col("h") + F.col("_k")).alias("h"), (F.col("demand") * 2).alias("demand"), F.lit("corrected").alias("note"))
    batch = f"{path}__batch"
    T.overwrite(with_day(twice), batch)
    for _ in range(2):  # idempotent
        T.upsert(spark, spark.read.parquet(batch), path, ["series", "h"], "p_day")
    return out(spark.read.option("mergeSchema", True).parquet(path).select("series", "h", "demand", "note"))


@query("rebuild_table", f"SELECT series, {DT('day')} AS date, {R('y')} AS y FROM v_dmean WHERE day >= (SELECT min(day) + 21 FROM v_dmean)")
def rebuild_table(spark, sf):
    path = shared_folder(spark, "rebuild")
    daily = explore.daily(I.demand(spark, sf), ["series"])
    T.append(daily, path)
    first = daily.agg((F.min("day") + 21).alias("d")).select("d").scalar()
    T.overwrite(daily.where(F.col("day") >= first), path)
    return out(spark.read.parquet(path))


@query("table_exists", "SELECT true AS events, false AS nothing, count(*) AS n FROM events")
def table_exists(spark, sf):
    here, nowhere = T.exists(spark, f"{sf}/events.parquet"), T.exists(spark, f"{sf}/nothing.parquet")
    return I.table(spark, sf, "events").agg(F.lit(here).alias("events"), F.lit(nowhere).alias("nothing"),
                                            F.count("*").alias("n"))


@query("load_source_cached", f"""
SELECT feed, count(*) AS n, count(DISTINCT ts) AS stamps FROM (
  SELECT 'consumption' AS feed, {TS('h')} AS ts FROM v_readings UNION ALL SELECT 'weather_obs', {TS('h')} FROM v_obs
  UNION ALL SELECT 'weather_fcst', {TS('h')} FROM v_vint UNION ALL SELECT 'calendar', CAST(date AS TIMESTAMP) FROM v_cal) GROUP BY feed""")
def load_source_cached(spark, sf):
    root = shared_folder(spark, "feeds")
    for name, df in I.feeds(spark, sf).items():
        T.overwrite(df, f"{root}/{name}")
    parts = None
    for name, df in T.parquet_feeds(spark, root).items():
        c = (F.col("date") if name == "calendar" else F.col("timestamp_local")).cast("timestamp_ntz")
        one = df.agg(F.lit(name).alias("feed"), F.count("*").alias("n"), F.count_distinct(c).alias("stamps"))
        parts = one if parts is None else parts.unionByName(one)
    return parts
