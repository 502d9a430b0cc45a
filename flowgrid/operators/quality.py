"""Row rules that quarantine and batch rules that block.

The row rules run in order and the first one a row fails owns it: null_value, out_of_range, duplicate_key,
frozen_value. Only rows that pass a rule are looked at by the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgrid.config import Quality
from flowgrid.functions.scalars import any_null, outside
from flowgrid.functions.timefns import day_of_hour
from flowgrid.operators.series import attach, stuck

ROW_RULES = ("null_value", "out_of_range", "duplicate_key", "frozen_value")


def early_reason(required: list[str], value: str | None, lo: float, hi: float) -> Column:
    """The two rules that need only the row itself."""
    reason = F.when(any_null(required), "null_value")
    return reason if value is None else reason.when(outside(value, lo, hi), "out_of_range")


def tag(df: DataFrame, key: list[str], row_id: str, order: list[str], required: list[str],
        value: str | None = None, lo: float = 0.0, hi: float = 0.0, stuck_hours: int = 0) -> DataFrame:
    """Add ``reason`` (null = clean).

    The surviving version of a key comes from an aggregate and is joined back on key + row_id. The unique row_id
    spreads the join, so a key with very many versions is not one partition. ``key`` ends with the position column.
    """
    pre = df.withColumn("_early", early_reason(required, value, lo, hi))
    clean = pre.where(F.col("_early").isNull())
    kept = clean.groupBy(*key).agg(
        F.max_by(row_id, F.struct(*order, row_id)).alias(row_id),
        *([F.max_by(value, F.struct(*order, row_id)).alias("_value")] if value else []))
    if stuck_hours:
        kept = stuck(kept, key[:-1], key[-1], "_value", stuck_hours)
    else:
        kept = kept.withColumn("is_stuck", F.lit(False))
    kept = kept.select(*key, row_id, "is_stuck")
    late = F.when(F.col("is_stuck").isNull(), "duplicate_key").when(F.col("is_stuck"), "frozen_value")
    return (pre.join(kept, [*key, row_id], "left")
            .withColumn("reason", F.coalesce(F.col("_early"), late)).drop("_early", "is_stuck"))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason").isNull()).drop("reason")


def quarantine(tagged: DataFrame, table: str) -> DataFrame:
    """table_name, reason, record_json of every rejected row."""
    row = [c for c in tagged.columns if c != "reason"]
    return tagged.where(F.col("reason").isNotNull()).select(
        F.lit(table).alias("table_name"), "reason",
        F.to_json(F.struct(*row), {"ignoreNullFields": "false"}).alias("record_json"))


def row_results(tagged: DataFrame, table: str, rules: tuple[str, ...] = ROW_RULES) -> DataFrame:
    """One row per rule, also for rules nothing failed."""
    counts = tagged.agg(*[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in rules])
    pairs = ", ".join(f"'{r}', `{r}`" for r in rules)
    long = counts.selectExpr(f"stack({len(rules)}, {pairs}) as (check_name, failed_rows)")
    n = F.col("failed_rows")
    return long.select(
        "check_name", F.lit(table).alias("table_name"), F.lit("warn").alias("severity"), (n == 0).alias("passed"),
        n.alias("failed_rows"), F.when(n == 0, "ok").otherwise(F.concat(n.cast("string"), F.lit(" rows rejected")))
        .alias("detail"))


def batch_span(raw: DataFrame, pos: str) -> DataFrame:
    """One row: first and last day the batch touches."""
    day = day_of_hour(pos)
    return raw.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def completeness(raw: DataFrame, clean: DataFrame, keys: list[str], pos: str, q: Quality) -> DataFrame:
    """Per series: expected, present and missing clean hours over the days of the batch, and the verdict.

    Quarantined hours count as missing; a series with no clean hour at all is still reported.
    """
    span = batch_span(raw, pos)
    hours = clean.groupBy(*keys).agg(F.count_distinct(pos).alias("present"))
    if keys:
        base = raw.groupBy(*keys).agg(F.count("*").alias("_n")).drop("_n").join(hours, keys, "left")
    else:
        base = hours
    base = attach(base, span, [])
    expected = (F.col("last_day") - F.col("first_day") + 1).cast("bigint") * 24
    present = F.coalesce(F.col("present"), F.lit(0))
    missing = F.greatest(F.col("expected") - F.col("present"), F.lit(0))
    allowed = F.greatest(F.lit(float(q.max_missing_hours)), F.col("expected") * F.lit(q.max_missing_pct / 100))
    return (base.select(*keys, expected.alias("expected"), present.alias("present"))
            .withColumn("missing", missing).withColumn("passed", F.col("missing") <= allowed))


def completeness_result(per_series: DataFrame, q: Quality) -> DataFrame:
    """The batch check over all series: fails when any series fails."""
    total = per_series.agg(F.sum("missing").alias("missing"), F.sum("expected").alias("expected"),
                           F.min(F.col("passed").cast("int")).alias("ok"))
    pct = F.coalesce(F.try_divide(F.lit(100.0) * F.col("missing"), F.col("expected")), F.lit(0.0))
    return total.select(
        F.lit("hourly_completeness").alias("check_name"), F.lit("consumption").alias("table_name"),
        F.lit("error").alias("severity"), (F.coalesce(F.col("ok"), F.lit(1)) == 1).alias("passed"),
        F.coalesce("missing", F.lit(0)).alias("failed_rows"),
        F.format_string(f"%d of %d hours lack a clean reading: %.2f%%; allowed {q.max_missing_pct:g}%% or {q.max_missing_hours} hours",
                        F.coalesce("missing", F.lit(0)), F.coalesce("expected", F.lit(0)), pct).alias("detail"))


def horizon_coverage(clean_fcst: DataFrame, keys: list[str], target_day: Column, issued: str = "issued_h",
                     pos: str = "h") -> DataFrame:
    """Distinct hours of ``target_day`` in vintages issued the day before it, one row (per location key)."""
    hit = (day_of_hour(issued) == target_day - 1) & (day_of_hour(pos) == target_day)
    return clean_fcst.groupBy(*keys).agg(F.count_distinct(F.when(hit, F.col(pos))).alias("hours"))


def horizon_result(coverage: DataFrame, target_day: str, horizon: int = 24) -> DataFrame:
    low = F.coalesce(F.min("hours"), F.lit(0))
    gap = F.greatest(F.lit(horizon) - F.col("hours"), F.lit(0))
    text = F.format_string(f"{target_day} lacks %d of {horizon} forecast hours", gap)
    return coverage.agg(low.alias("hours")).select(
        F.lit("forecast_horizon_coverage").alias("check_name"), F.lit("weather_fcst").alias("table_name"),
        F.lit("error").alias("severity"), (gap == 0).alias("passed"), gap.cast("bigint").alias("failed_rows"),
        F.when(gap == 0, "ok").otherwise(text).alias("detail"))


def freshness(latest_day: Column, today: Column, allow_no_new: bool = False) -> Column:
    """With no new batch: pass when yesterday is present, or when any history is and that is allowed."""
    fresh = F.coalesce(latest_day >= today - 1, F.lit(False))
    return fresh | (F.lit(allow_no_new) & latest_day.isNotNull())


def verdict(results: DataFrame) -> Column:
    """Aggregate: true unless a blocking check failed."""
    return F.coalesce(F.min(F.when(F.col("severity") == "error", F.col("passed").cast("int"))), F.lit(1)) == 1


# fault -> feed it breaks, rows it takes away (last_day: newest day of the batch)
FAULTS = {
    "missing_forecast": ("weather_fcst", lambda pos, last_day: F.lit(True)),
    "meter_outage": ("consumption", lambda pos, last_day: (pos - last_day * 24).between(6, 13)),
}


def inject_fault(batch: DataFrame, fault: str, feed: str, pos: str = "h") -> DataFrame:
    """The batch without the rows that a fault takes from this feed."""
    if fault != "none" and fault not in FAULTS:
        raise ValueError(f"unknown fault {fault!r}; known: none, {', '.join(FAULTS)}")
    broken, gone = FAULTS.get(fault, ("", None))
    if feed != broken:
        return batch
    last = batch.agg(F.max(day_of_hour(pos)).alias("_last_day"))
    return attach(batch, last, []).where(~gone(F.col(pos), F.col("_last_day"))).drop("_last_day")
