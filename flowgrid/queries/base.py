"""Registry: each query next to the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.functions.timefns import day_date, hour_ts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the views of VIEWS."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = expand(sql)
        return fn
    return add


def out(df: DataFrame, digits: int = 6) -> DataFrame:
    """Edge of a query: h -> ts, day -> date, doubles rounded.

    Rounding adds a thousandth of the last digit first: averages of cents over 2^k hours often end in an exact half,
    and the last bit of a sum depends on the order it was added up in.
    """
    cols = []
    for n, t in df.dtypes:
        if n == "h":
            cols.append(hour_ts("h").alias("ts"))
        elif n == "day" and t != "date":
            cols.append(day_date("day").alias("date"))
        elif t == "double":
            cols.append(F.round(F.col(n) + F.lit(3.3 * 10.0 ** -(digits + 3)), digits).alias(n))
        else:
            cols.append(F.col(n))
    return df.select(*cols)


def R(expr: str, digits: int = 6) -> str:
    """SQL text of the same rounding."""
    return f"round(({expr}) + {3.3 * 10.0 ** -(digits + 3)!r}::DOUBLE, {digits})"


def TS(h: str) -> str:
    return f"make_timestamp(CAST(({h}) AS BIGINT) * 3600000000)"


def DT(day: str) -> str:
    return f"(DATE '1970-01-01' + CAST({day} AS INTEGER))"


def _calendar(span: str, ahead: int) -> str:
    return f"""
      SELECT day, {DT('day')} AS date, (day - 19723) % 10 = 9 AS is_public_holiday,
        CASE WHEN (day - 19723) % 20 = 19 THEN 'Eid al-Fitr' WHEN (day - 19723) % 10 = 9 THEN 'Founding Day' END
          AS holiday_name,
        (day + 3) % 7 >= 5 AS is_weekend, (day - 19723) % 30 BETWEEN 10 AND 19 AS is_ramadan,
        CASE WHEN (day - 19723) % 30 BETWEEN 10 AND 19 THEN (day - 19723) % 30 - 9 ELSE 0 END AS ramadan_day,
        (day - 19723) % 14 < 3 AS is_school_break,
        CASE WHEN (day - 19723) % 12 = 3 THEN 'structural' WHEN (day - 19723) % 12 = 5 THEN 'operational'
             WHEN (day - 19723) % 12 IN (7, 8) THEN 'weather' END AS event_type,
        CASE WHEN (day - 19723) % 12 = 3 THEN 'event-structural' WHEN (day - 19723) % 12 = 5 THEN 'event-operational'
             WHEN (day - 19723) % 12 IN (7, 8) THEN 'event-weather' END AS event_name
      FROM (SELECT unnest(generate_series(lo, hi + {ahead})) AS day FROM ({span}))"""


def _positive(text: str) -> str:
    """Floor modulo: the calendar pattern also runs before its origin."""
    return re.sub(r"\(day - 19723\) % (\d+)", r"((((day - 19723) % \1) + \1) % \1)", text)


VIEWS: dict[str, str] = {
    "v_ev": """SELECT event_id, event_type AS series, epoch_us(ts) // 3600000000 AS h, value, user_id FROM events""",
    "v_demand": """SELECT series, h, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS demand
      FROM v_ev GROUP BY ALL""",
    "v_total": """SELECT h, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS demand FROM v_ev GROUP BY ALL""",
    "v_counts": """SELECT series, h, count(*) AS n FROM v_ev GROUP BY ALL""",
    "v_readings": """SELECT series, h, event_id AS row_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS demand
      FROM v_ev""",
    "v_obs": """SELECT h, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS temperature,
        CAST(sum(CAST(user_id % 100 AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS humidity,
        CAST(sum(CAST(CASE WHEN event_id % 11 = 0 THEN value ELSE 0 END AS DECIMAL(12,2))) AS DOUBLE) AS rain
      FROM v_ev WHERE series = 'view' GROUP BY h""",
    "v_vint": """SELECT (h // 24) * 24 + 6 AS issued_h, (h // 24 + 1) * 24 + event_id % 41 AS h, value AS temperature,
        CAST(user_id % 100 AS DOUBLE) AS humidity, CASE WHEN event_id % 13 = 0 THEN value ELSE 0.0::DOUBLE END AS rain,
        event_id AS row_id FROM v_ev""",
    "v_cal": _positive(_calendar("SELECT min(h) // 24 AS lo, max(h) // 24 AS hi FROM v_ev", 3)),
    "v_daily": """SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS y FROM orders GROUP BY ALL""",
    "v_prio": """SELECT o_orderpriority AS series,
        CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS y FROM orders GROUP BY ALL""",
    "v_lcal": _positive(_calendar("SELECT min(day) AS lo, max(day) AS hi FROM v_daily", 0)),
    "v_oday": """SELECT o.*, c.* FROM orders o JOIN v_lcal c ON c.day = date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))""",
    "v_eday": """SELECT e.event_id, c.* EXCLUDE (event_type), c.event_type AS day_event FROM events e JOIN v_cal c ON c.day = epoch_us(ts) // 86400000000""",
    "v_wide": """SELECT d.series, d.h, d.demand AS y, a.demand AS naive_48, b.demand AS naive_168,
        (b.demand + c.demand + e.demand) / 3 AS mean_3w
      FROM v_demand d JOIN v_demand a ON a.series = d.series AND a.h = d.h - 48
      JOIN v_demand b ON b.series = d.series AND b.h = d.h - 168
      JOIN v_demand c ON c.series = d.series AND c.h = d.h - 336
      JOIN v_demand e ON e.series = d.series AND e.h = d.h - 504""",
    "v_pred": """SELECT series, h, y, model, pred, CAST((h // 24 + 3) // 7 AS INTEGER) AS fold FROM (
        SELECT series, h, y, 'naive_48' AS model, naive_48 AS pred FROM v_wide
        UNION ALL SELECT series, h, y, 'naive_168', naive_168 FROM v_wide
        UNION ALL SELECT series, h, y, 'mean_3w', mean_3w FROM v_wide)""",
    "v_lwide": """SELECT d.day, d.y, a.y AS naive_7, e.y AS naive_364, (a.y + b.y + c.y) / 3 AS mean_3w
      FROM v_daily d JOIN v_daily a ON a.day = d.day - 7 JOIN v_daily b ON b.day = d.day - 14
      JOIN v_daily c ON c.day = d.day - 21 JOIN v_daily e ON e.day = d.day - 364""",
    "v_lpred": f"""SELECT day, y, model, pred, CAST(date_trunc('month', {DT('day')}) AS DATE) AS fold FROM (
        SELECT day, y, 'naive_7' AS model, naive_7 AS pred FROM v_lwide
        UNION ALL SELECT day, y, 'naive_364', naive_364 FROM v_lwide
        UNION ALL SELECT day, y, 'mean_3w', mean_3w FROM v_lwide)""",
    "v_log": """SELECT series, h, (h // 24 - 1) * 24 + 5 AS issued_h, 1 AS created_seq, '1' AS model_version,
        round(naive_168, 3) AS predicted_m3 FROM v_wide
      UNION ALL SELECT series, h, (h // 24 - 1) * 24 + 5 + h % 2, 2, '2', round(mean_3w, 3) FROM v_wide""",
    "v_best": """SELECT * FROM v_log
      QUALIFY row_number() OVER (PARTITION BY series, h ORDER BY issued_h DESC, created_seq DESC) = 1""",
    "v_rec": """SELECT b.series, b.h, b.h // 24 AS forecast_day, b.issued_h, b.model_version, b.predicted_m3,
        d.demand AS actual_m3, b.predicted_m3 - d.demand AS error_m3,
        CASE WHEN d.demand > 0 THEN abs(b.predicted_m3 - d.demand) / d.demand * 100 END AS abs_pct_error
      FROM v_best b JOIN v_demand d ON d.series = b.series AND d.h = b.h""",
    "v_acc": """SELECT series, forecast_day, count(*) AS hours_scored, avg(abs_pct_error) AS mape,
        sum(abs(error_m3)) / nullif(sum(actual_m3), 0) * 100 AS wape,
        sum(error_m3) / nullif(sum(actual_m3), 0) * 100 AS bias_pct, max(abs_pct_error) AS max_abs_pct_error
      FROM v_rec GROUP BY ALL""",
    "v_pick": """SELECT h, issued_h, temperature, humidity, rain FROM v_vint WHERE issued_h // 24 = h // 24 - 1
      QUALIFY row_number() OVER (PARTITION BY h ORDER BY issued_h DESC, row_id DESC) = 1""",
    "v_grid": """SELECT series, unnest(generate_series(lo, hi)) AS h
      FROM (SELECT series, min(h) AS lo, max(h) AS hi FROM v_demand GROUP BY series)""",
    "v_tagged": """SELECT t.*, CASE WHEN early IS NOT NULL THEN early WHEN rn > 1 THEN 'duplicate_key'
          WHEN run_len >= 3 THEN 'frozen_value' END AS reason
      FROM (SELECT *, CASE WHEN early IS NULL AND rn = 1 THEN count(*) OVER (PARTITION BY series, keep, run) END AS run_len
        FROM (SELECT *, sum(brk) OVER (PARTITION BY series, keep ORDER BY h, row_id) AS run
          FROM (SELECT *, CASE WHEN keep AND demand = lag(demand) OVER (PARTITION BY series, keep ORDER BY h, row_id)
                AND h - lag(h) OVER (PARTITION BY series, keep ORDER BY h, row_id) = 1 THEN 0 ELSE 1 END AS brk
            FROM (SELECT *, early IS NULL AND rn = 1 AS keep
              FROM (SELECT *, CASE WHEN early IS NULL THEN
                    row_number() OVER (PARTITION BY series, h, early IS NULL ORDER BY row_id DESC) END AS rn
                FROM (SELECT *, CASE WHEN demand IS NULL THEN 'null_value'
                      WHEN demand < 0 OR demand > 200 THEN 'out_of_range' END AS early FROM v_readings)))))) t""",
    "v_dmean": """SELECT series, h // 24 AS day, avg(demand) AS y FROM v_demand GROUP BY ALL""",
    "v_level": """SELECT series, day, y, CASE WHEN count(y) OVER w >= 14 THEN avg(y) OVER w END AS level FROM v_dmean
      WINDOW w AS (PARTITION BY series ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING)""",
    "v_rel": """SELECT d.series, d.h, d.h // 24 AS day, CAST(d.h % 24 AS INTEGER) AS hour, d.demand, l.level,
        d.demand / nullif(l.level, 0) AS rel
      FROM v_demand d LEFT JOIN v_level l ON l.series = d.series AND l.day = d.h // 24""",
    "v_llevel": """SELECT day, y, CASE WHEN count(y) OVER a >= 14 THEN avg(y) OVER a END AS level,
        CASE WHEN count(y) OVER b >= 180 THEN avg(y) OVER b END AS level365 FROM v_daily
      WINDOW a AS (ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING),
             b AS (ORDER BY day RANGE BETWEEN 182 PRECEDING AND 182 FOLLOWING)""",
    "v_dobs": """SELECT h // 24 AS day, avg(temperature) AS tmean, max(temperature) AS tmax, sum(rain) AS rain,
        avg(humidity) AS hum FROM v_obs GROUP BY ALL""",
    "v_tot": """SELECT h // 24 AS day, avg(demand) AS y, sum(demand) AS total FROM v_total GROUP BY ALL""",
    "v_dd": """SELECT t.day, t.y, l.level, t.y / l.level AS rel, o.tmean, o.tmax, o.rain, o.hum, c.is_public_holiday,
        c.holiday_name, c.is_ramadan, c.ramadan_day, c.is_weekend, c.is_school_break, c.event_type, c.event_name
      FROM v_tot t JOIN (SELECT day, CASE WHEN count(y) OVER w >= 14 THEN avg(y) OVER w END AS level FROM v_tot
        WINDOW w AS (ORDER BY day RANGE BETWEEN 14 PRECEDING AND 13 FOLLOWING)) l ON l.day = t.day
      LEFT JOIN v_dobs o ON o.day = t.day LEFT JOIN v_cal c ON c.day = t.day""",
}


def expand(sql: str) -> str:
    """Prefix a query with the views it uses, directly or through other views."""
    need: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in set(re.findall(r"\bv_\w+\b", text)) & VIEWS.keys() - need:
            need.add(name)
            todo.append(VIEWS[name])
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({b})" for n, b in VIEWS.items() if n in need)
    sql = sql.strip()
    if not ctes:
        return sql
    return f"WITH {ctes}{',' + sql[4:] if sql[:5].upper() == 'WITH ' else ' ' + sql}"
