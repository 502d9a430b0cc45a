"""Exploratory statistics of a demand series and its drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.scalars import bin_right, first_match, ratio
from flowgrid.functions.timefns import day_date, day_of_hour, hour_of_day
from flowgrid.operators.series import DAY_CHUNK, attach, banded, centred_mean, lag_table, on_grid, run_lengths, runs

LEVEL_DAYS, LEVEL_LEAST = 28, 14
YEAR_DAYS, YEAR_LEAST = 365, 180


def day_type(eid_first: bool = False) -> Column:
    """Holiday > Ramadan > weekend > weekday; optionally with Eid days split off first."""
    cases = [(F.coalesce(F.col("holiday_name").contains("Eid"), F.lit(False)), "Eid")] if eid_first else []
    cases += [(F.col("is_public_holiday"), "other holiday" if eid_first else "public holiday"),
              (F.col("is_ramadan"), "Ramadan"), (F.col("is_weekend"), "weekend")]
    return first_match(cases, "weekday")


def season(month: Column) -> Column:
    return first_match([(month.isin(5, 6, 7, 8, 9), "summer"), (month.isin(12, 1, 2), "winter")], "shoulder")


def daily(df: DataFrame, keys: list[str], value: str = "demand", pos: str = "h") -> DataFrame:
    """keys, day, y: mean of the present hours."""
    return df.groupBy(*keys, day_of_hour(pos).alias("day")).agg(F.avg(value).alias("y"))


def local_level(day_df: DataFrame, keys: list[str], width: int = LEVEL_DAYS, least: int = LEVEL_LEAST,
                out: str = "level") -> DataFrame:
    """Daily value with its centred level; gaps count by calendar day, not by row."""
    return centred_mean(day_df, keys, "day", "y", width, least, out)


def relative(df: DataFrame, keys: list[str], value: str = "demand", width: int = LEVEL_DAYS,
             least: int = LEVEL_LEAST, out: str = "rel") -> DataFrame:
    """Hourly value relative to the centred daily level."""
    lvl = local_level(daily(df, keys, value), keys, width, least).select(*keys, "day", "level")
    return (df.withColumn("day", day_of_hour("h")).withColumn("hour", hour_of_day("h"))
            .join(lvl, [*keys, "day"], "left").withColumn(out, ratio(F.col(value), F.col("level"))))


def coverage(df: DataFrame, name: str, pos: str, to_ts) -> DataFrame:
    """Rows, span, expected and missing positions, and duplicated positions of one table.

    Distinct positions come from a two-step count, so a duplicated position combines map-side.
    """
    width = F.lit(len(df.columns)).alias("columns")
    per = df.groupBy(pos).agg(F.count("*").alias("_c"))
    out = per.agg(F.sum("_c").alias("rows"), F.min(pos).alias("_lo"), F.max(pos).alias("_hi"),
                  F.count(pos).alias("_d"))
    expected = (F.col("_hi") - F.col("_lo") + 1).cast("bigint")
    return out.select(F.lit(name).alias("table_name"), "rows", width, to_ts("_lo").cast("timestamp_ntz").alias("start"),
                      to_ts("_hi").cast("timestamp_ntz").alias("end"), expected.alias("expected_rows"),
                      (expected - F.col("_d")).alias("missing"), (F.col("rows") - F.col("_d")).alias("duplicates"))


def gap_runs(df: DataFrame, keys: list[str], value: str = "demand", pos: str = "h") -> DataFrame:
    """How many runs of missing readings there are of each length."""
    full = on_grid(df, keys, pos)
    miss = F.col(value).isNull()
    tagged = runs(full.withColumn("_m", miss), keys, pos, F.col("_m") != F.col("prev__m"), {"_m": F.col("_m")})
    per = run_lengths(tagged.where(F.col("_m")), keys, pos)
    return per.groupBy(*keys, "run_len").agg(F.count("*").alias("gaps"))


def frozen_rows(df: DataFrame, keys: list[str], value: str, least: int = 3, pos: str = "h") -> DataFrame:
    """Exploratory stuck test: ``least`` or more equal readings in a row, however far apart in time."""
    changed = F.coalesce(F.col(value) != F.col("prev_v"), F.lit(True))
    tagged = runs(df, keys, pos, changed, {"v": F.col(value)})
    per = run_lengths(tagged, keys, pos).where(F.col("run_len") >= least).select(*keys, "run_start", "run_len")
    return tagged.join(per, [*keys, "run_start"])


def yoy(day_df: DataFrame, keys: list[str], width: int = LEVEL_DAYS, back: int = 364) -> DataFrame:
    """Smoothed level against the level ``back`` days earlier, in %."""
    lvl = centred_mean(day_df, keys, "day", "y", width, None, "level").select(*keys, "day", "level")
    old = lag_table(lvl, keys, "day", "level", {"level_before": back})
    out = lvl.join(old, [*keys, "day"])
    return out.withColumn("yoy_pct", (ratio(F.col("level"), F.col("level_before")) - 1) * 100)


def event_blocks(calendar: DataFrame) -> DataFrame:
    """Merge consecutive days of the same event (one row per calendar day goes in)."""
    ev = calendar.where(F.col("event_type").isNotNull())
    breaks = (F.col("event_name") != F.col("prev_name")) | (F.col("day") - F.col("prev_d") != 1)
    tagged = runs(ev, [], "day", breaks, {"name": F.col("event_name"), "d": F.col("day")}, DAY_CHUNK)
    return tagged.groupBy("run_start").agg(
        F.min_by("event_name", "day").alias("event"), F.min_by("event_type", "day").alias("type"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"))


def loglinear(day_df: DataFrame, keys: list[str]) -> DataFrame:
    """Log-linear growth: slope and intercept of ln(y) on the day number since the first day."""
    first = day_df.groupBy(*keys).agg(F.min("day").alias("_d0"))
    x = attach(day_df.where(F.col("y") > 0), first, keys).withColumn("t", (F.col("day") - F.col("_d0")).cast("double"))
    ly = F.log("y")
    return x.groupBy(*keys).agg(F.regr_slope(ly, F.col("t")).alias("slope"),
                                F.regr_intercept(ly, F.col("t")).alias("intercept")).withColumn(
        "annual_growth_pct", F.expm1(F.col("slope") * 365) * 100)


def seasonal_index(day_df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of daily value / 365-day level per calendar month."""
    lvl = local_level(day_df, keys, YEAR_DAYS, YEAR_LEAST)
    return lvl.groupBy(*keys, F.month(day_date("day")).alias("month")).agg(
        F.avg(ratio(F.col("y"), F.col("level"))).alias("season_index"), F.count("level").alias("days"))


def decompose(df: DataFrame, keys: list[str], value: str = "demand") -> DataFrame:
    """Classical additive split of an hourly grid: trend (centred week), daily, weekly and remainder.

    Seasonal parts are group means: by hour of day of the detrended series, then by hour of week of what is left.
    """
    lo, hi = -84, 83
    t = banded(df, keys, "h", {"_n": (lo, hi, lambda w: F.count(value).over(w)),
                               "_m": (lo, hi, lambda w: F.avg(value).over(w))})
    t = t.withColumn("trend", F.when(F.col("_n") >= 84, F.col("_m"))).drop("_n", "_m")
    t = (t.where(F.col("trend").isNotNull() & F.col(value).isNotNull())
         .withColumn("_d", F.col(value) - F.col("trend")).withColumn("hour", hour_of_day("h"))
         .withColumn("week_hour", F.pmod(F.col("h") + 72, F.lit(168)).cast("int")))
    s24 = t.groupBy(*keys, "hour").agg(F.avg("_d").alias("daily"))
    t = t.join(F.broadcast(s24) if not keys else s24, [*keys, "hour"]).withColumn("_w", F.col("_d") - F.col("daily"))
    s168 = t.groupBy(*keys, "week_hour").agg(F.avg("_w").alias("weekly"))
    t = t.join(F.broadcast(s168) if not keys else s168, [*keys, "week_hour"])
    return t.withColumn("remainder", F.col("_w") - F.col("weekly")).drop("_d", "_w")


def strength(parts: DataFrame, keys: list[str]) -> DataFrame:
    """F = max(0, 1 - var(remainder) / var(component + remainder)) per component."""
    def f(c: str) -> Column:
        share = ratio(F.var_samp("remainder"), F.var_samp(F.col(c) + F.col("remainder")))
        return F.greatest(1 - share, F.lit(0.0)).alias(f"strength_{c}")
    return parts.groupBy(*keys).agg(f("trend"), f("daily"), f("weekly"))


def hinge_scan(df: DataFrame, x: str, y: str, lo: float, hi: float, step: float) -> DataFrame:
    """SSE of y ~ 1 + (x - knot)+ on a grid of knots; the best knot is ``min_by`` of (sse, knot).

    A row adds to the moments of one bucket between two knots. What a knot needs are the moments of all buckets above it:
    suffix sums over the rows of the grid. Knots below every row fit alike, as they only shift x: they get one and the same
    SSE, so rounding does not choose among them.
    """
    n = int(round((hi - lo) / step)) + 1
    u = F.col("_x") - F.lit(lo)
    bucket = F.least(F.greatest(F.ceil(u / F.lit(step)), F.lit(0)), F.lit(n))  # the number of knots below x
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    moments = {"_n": F.lit(1.0), "_u": u, "_uu": u * u, "_yu": u * F.col("_y"), "_sy": F.col("_y"), "_yy": F.col("_y") * F.col("_y")}
    sums = known.groupBy(bucket.cast("bigint").alias("_b")).agg(*[F.sum(c).alias(k) for k, c in moments.items()])
    every = df.sparkSession.range(n + 1).withColumnRenamed("id", "_b").join(sums, "_b", "left")
    order = Window.orderBy(F.desc("_b"))  # a row for each knot
    above = every.select("_b", *[F.coalesce(F.sum(k).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias(k) for k in moments],
                         *[F.coalesce(F.sum(k).over(Window.orderBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0)).alias(f"{k}_all")
                           for k in ("_n", "_sy", "_yy")]).where(F.col("_b") < n)
    count = F.col("_n_all")
    k = F.when(F.col("_n") < count, F.col("_b") * F.lit(step)).otherwise(0.0)
    z, zz, zy = F.col("_u") - k * F.col("_n"), F.col("_uu") - 2 * k * F.col("_u") + k * k * F.col("_n"), F.col("_yu") - k * F.col("_sy")
    s = above.where(count > 0).select(F.round(F.lit(lo) + F.col("_b") * F.lit(step), 6).alias("knot"), (F.col("_yy_all") - F.col("_sy_all") * F.col("_sy_all") / count).alias("syy"),
                                      (zy - z * F.col("_sy_all") / count).alias("sxy"), (zz - z * z / count).alias("sxx"))
    sse = F.col("syy") - F.coalesce(F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    return s.select("knot", sse.alias("sse"), F.try_divide("sxy", "sxx").alias("slope"))


def binned(df: DataFrame, x: str, y: str, lo: float, width: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """Mean and count of y per (lo, lo + w] bin of x; smaller values are in bin -1, larger ones in bin ``bins``."""
    b = F.least(F.greatest(bin_right(x, lo, width), F.lit(-1)), F.lit(bins))
    known = df.where(F.col(x).isNotNull()).withColumn("bin", b)
    return known.groupBy("bin", *(by or [])).agg(F.avg(y).alias("mean"), F.count(y).alias("n"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long correlation matrix (a, b, r) from one aggregate over pairwise complete rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {cells}) as (a, b, r)")


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, mean, std, min, max, bias-corrected skewness and coefficient of variation (%)."""
    n = F.count(value).cast("double")
    skew = F.skewness(value) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), skew.alias("skew"),
        (ratio(F.stddev_samp(value), F.avg(value)) * 100).alias("cv_pct"))


def class_history(days: DataFrame, keys: list[str], klass: str, gap: int = 2, take: int = 8,
                  least: int = 3) -> DataFrame:
    """keys, day, src_day: the last ``take`` days of the day's class that end ``gap`` days before it.

    With fewer than ``least`` such days the last ``take`` days of any class stand in. Days are ranked inside their
    class, an as-of pass finds the newest usable rank, and the ranks just below it are joined by equality - no day is
    joined to all of its past.
    """
    def newest_rank(part: list[str], ranked: DataFrame, name: str) -> DataFrame:
        facts = ranked.select(*part, (F.col("day") + gap).alias("day"), "_rk", F.lit(0).alias("_o"))
        asks = ranked.select(*part, "day", F.lit(None).cast("int").alias("_rk"), F.lit(1).alias("_o"))
        upto = Window.partitionBy(*part).orderBy("day", "_o").rowsBetween(Window.unboundedPreceding, 0)
        both = facts.unionByName(asks).withColumn(name, F.max("_rk").over(upto))
        return both.where(F.col("_o") == 1).select(*part, "day", name)

    def ranks(part: list[str]) -> DataFrame:
        return days.select(*keys, klass, "day", F.row_number().over(
            Window.partitionBy(*part).orderBy("day")).alias("_rk"))

    same_part, any_part = [*keys, klass], list(keys)
    same, every = ranks(same_part), ranks(any_part)
    tgt = newest_rank(same_part, same, "_same").join(newest_rank(any_part, every, "_any"), [*keys, "day"])
    use_same = F.coalesce(F.col("_same") >= least, F.lit(False))

    def sources(rows: DataFrame, top: str, part: list[str], ranked: DataFrame) -> DataFrame:
        wanted = F.explode(F.sequence(F.greatest(F.col(top) - (take - 1), F.lit(1)), F.col(top))).alias("_rk")
        src = ranked.select(*part, "_rk", F.col("day").alias("src_day"))
        return rows.where(F.col(top).isNotNull()).select(*keys, klass, "day", wanted).join(src, [*part, "_rk"]).select(
            *keys, "day", "src_day")

    return sources(tgt.where(use_same), "_same", same_part, same).unionByName(
        sources(tgt.where(~use_same), "_any", any_part, every))
