"""Operators on gappy integer-positioned series.

A series may be one hot key holding a third of all rows, so nothing here puts a whole series in one task:

* ``banded``  - RANGE-frame windows over (series, chunk) partitions; a row is copied to the neighbouring chunks
  its frames can reach, so a chunk is self-contained and the copy factor is 1 + reach / chunk.
* ``carry``   - nearest known value before / after a row, as a two-level scan: inside the chunk, then across one
  summary row per chunk.
* ``lag_join``- offset equi-join; never a positional lag on gappy rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.functions.scalars import col

HOUR_CHUNK = 24 * 7 * 12
DAY_CHUNK = 365 * 4

Frame = tuple[int, int, Callable]


def attach(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of a one-row-per-key summary. Without keys the single row enters as a scalar subquery.

    A null key is a key like any other. Rows whose key has no summary are left out.
    """
    if keys:
        other = per_key.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        return df.join(other, same).drop(*[f"_of_{k}" for k in keys])
    names = per_key.columns
    row = per_key.select(F.struct(*names)).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col("_row")[n].alias(n) for n in names])


def _spread(df: DataFrame, pos: str, lo: int, hi: int, chunk: int) -> DataFrame:
    """Rows in their own chunk (``_home`` = ``_chunk``) and in those that look at them from ``lo`` to ``hi`` positions away."""
    p = F.col(pos)
    copies = F.sequence(F.floor((p - max(hi, 0)) / chunk), F.floor((p - min(lo, 0)) / chunk))
    return df.withColumn("_home", F.floor(p / chunk)).withColumn("_chunk", F.explode(copies))


def banded(df: DataFrame, keys: list[str], pos: str, frames: dict[str, Frame], chunk: int = HOUR_CHUNK,
           where: Column | None = None) -> DataFrame:
    """Add window aggregates over position ranges.

    ``frames`` maps output name -> (lo, hi, fn); ``fn(window)`` builds the column over rows whose position lies in
    [pos + lo, pos + hi]. All frames share one shuffle and one sort. ``where`` keeps only some rows afterwards.
    """
    spread = _spread(df, pos, min(f[0] for f in frames.values()), max(f[1] for f in frames.values()), chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    out = spread.select("*", *[fn(w.rangeBetween(a, b)).alias(name) for name, (a, b, fn) in frames.items()])
    keep = F.col("_chunk") == F.col("_home")
    return out.where(keep if where is None else keep & where).drop("_chunk", "_home")


def carry(df: DataFrame, keys: list[str], pos: str, known: Column, payload: dict[str, Column | str],
          chunk: int = HOUR_CHUNK, forward: bool = True, backward: bool = False,
          inclusive: bool = True) -> DataFrame:
    """Add ``prev_<name>`` (and ``next_<name>``) from the nearest row where ``known`` holds.

    ``inclusive`` lets a row be its own neighbour. Positions must be unique per series.
    """
    item = F.when(known, F.struct(F.col(pos).alias("_p"), *[col(c).alias(n) for n, c in payload.items()]))
    base = df.withColumn("_chunk", F.floor(F.col(pos) / chunk)).withColumn("_item", item)
    summary = base.groupBy(*keys, "_chunk").agg(
        F.max_by("_item", F.when(F.col("_item").isNotNull(), F.col(pos))).alias("_last"),
        F.min_by("_item", F.when(F.col("_item").isNotNull(), F.col(pos))).alias("_first"),
    )
    across = Window.partitionBy(*keys).orderBy("_chunk")
    ups, downs = (Window.unboundedPreceding, Window.unboundedFollowing)
    summary = summary.select(
        *keys, "_chunk",
        F.last("_last", ignorenulls=True).over(across.rowsBetween(ups, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(across.rowsBetween(1, downs)).alias("_after"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    edge = 0 if inclusive else 1
    cols = []
    if forward:
        cols.append(F.last("_item", ignorenulls=True).over(inside.rowsBetween(ups, -edge)).alias("_prev"))
    if backward:
        cols.append(F.first("_item", ignorenulls=True).over(inside.rowsBetween(edge, downs)).alias("_next"))
    out = base.select("*", *cols).join(summary, [*keys, "_chunk"], "left")
    for on, local, far, prefix in ((forward, "_prev", "_before", "prev_"), (backward, "_next", "_after", "next_")):
        if on:
            near = F.coalesce(F.col(local), F.col(far))
            out = out.withColumns({prefix + n: near[n] for n in payload})
    return out.drop("_chunk", "_item", "_prev", "_next", "_before", "_after")


def grid(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Every position between the first and last of each series."""
    ends = df.groupBy(*keys).agg(F.min(pos).alias("_lo"), F.max(pos).alias("_hi")).where(F.col("_lo").isNotNull())
    return ends.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(pos))


def on_grid(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The series on its complete grid; absent positions become nulls."""
    return grid(df, keys, pos).join(df, [*keys, pos], "left")


def lag_table(df: DataFrame, keys: list[str], pos: str, value: str, lags: dict[str, int]) -> DataFrame:
    """One row per (series, position) with the value ``lag`` positions earlier under each name."""
    offsets = F.explode(F.array(*[F.lit(k) for k in lags.values()])).alias("_lag")
    shifted = df.select(*keys, F.col(pos), value, offsets).withColumn(pos, F.col(pos) + F.col("_lag"))
    return shifted.groupBy(*keys, pos).agg(
        *[F.max(F.when(F.col("_lag") == k, F.col(value))).alias(n) for n, k in lags.items()])


def lag_join(targets: DataFrame, df: DataFrame, keys: list[str], pos: str, value: str,
             lags: dict[str, int]) -> DataFrame:
    """Left-join offset values on to target rows."""
    return targets.join(lag_table(df, keys, pos, value, lags), [*keys, pos], "left")


def previous_row(df: DataFrame, keys: list[str], pos: str, payload: dict[str, Column | str],
                 chunk: int = HOUR_CHUNK) -> DataFrame:
    """``prev_<name>`` taken from the row just before, however far away it is."""
    return carry(df, keys, pos, F.lit(True), payload, chunk, inclusive=False)


def runs(df: DataFrame, keys: list[str], pos: str, starts: Column, payload: dict[str, Column | str],
         chunk: int = HOUR_CHUNK) -> DataFrame:
    """Add ``run_start``: the position where the current run began.

    ``starts`` may use ``prev_<name>`` of the payload; a row with no predecessor always starts a run. One sorted scan of the
    chunks marks the starts inside them and sums every chunk up in a row (its first row, its last payload, its last start
    inside); a scan of these rows alone tells whether a chunk's first row starts a run and which run it goes on with.
    """
    w = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    begins = F.coalesce(starts, F.lit(True))
    marked = df.withColumn("_chunk", F.floor(F.col(pos) / chunk)).select(
        "*", F.row_number().over(w).alias("_i"), *[F.lag(col(c)).over(w).alias(f"prev_{n}") for n, c in payload.items()])
    marked = marked.withColumn("_at", F.when((F.col("_i") > 1) & begins, F.col(pos))).drop(*[f"prev_{n}" for n in payload])
    marked = marked.withColumn("_inside", F.last("_at", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = F.struct(*[col(c).alias(n) for n, c in payload.items()])
    chunks = marked.groupBy(*keys, "_chunk").agg(F.min_by(F.struct(*df.columns), pos).alias("_row"), F.max_by(ends, pos).alias("_last"),
                                                 F.max("_inside").alias("_inside"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    first = chunks.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_chunk", "_row", "_inside", F.lag("_last").over(across).alias("_before")).select(
        *[f"_of_{k}" for k in keys], "_chunk", "_inside", "_before", "_row.*", *[F.col("_before")[n].alias(f"prev_{n}") for n in payload])
    own = F.when(F.col("_before").isNull() | begins, F.col(pos))
    first = first.select(*[F.col(f"_of_{k}").alias(k) for k in keys], "_chunk", own.alias("_own"), F.coalesce("_inside", own).alias("_end"))
    going = F.last("_end", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    open_run = first.select(*keys, "_chunk", F.coalesce("_own", going).alias("_open"))
    out = attach(marked, open_run, [*keys, "_chunk"])
    return out.withColumn("run_start", F.coalesce("_inside", "_open")).drop("_chunk", "_i", "_at", "_inside", "_open")


def run_lengths(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Collapse a frame with ``run_start`` to one row per run."""
    return df.groupBy(*keys, "run_start").agg(F.count("*").alias("run_len"), F.max(pos).alias("run_end"))


def stuck(df: DataFrame, keys: list[str], pos: str, value: str, least: int, chunk: int = HOUR_CHUNK) -> DataFrame:
    """Add ``is_stuck``: the row is part of ``least`` or more identical values one position apart.

    A row is stuck when some block of ``least`` consecutive positions around it is full and flat, so a look of
    least - 1 positions each way decides it - no run numbering over the series is needed.
    """
    frames: dict[str, Frame] = {}
    flat = F.lit(False)
    for back in range(least):
        a, b = -back, least - 1 - back
        frames[f"_n{back}"] = (a, b, lambda w: F.count(value).over(w))
        frames[f"_lo{back}"] = (a, b, lambda w: F.min(value).over(w))
        frames[f"_hi{back}"] = (a, b, lambda w: F.max(value).over(w))
        flat = flat | ((F.col(f"_n{back}") == least) & (F.col(f"_lo{back}") == F.col(f"_hi{back}")))
    out = banded(df, keys, pos, frames, chunk)
    return out.withColumn("is_stuck", F.coalesce(flat, F.lit(False))).drop(*frames)


def interpolate(df: DataFrame, keys: list[str], pos: str, value: str, limit: int, out: str = "filled",
                chunk: int = HOUR_CHUNK) -> DataFrame:
    """Linear interpolation on a complete grid, filling at most the first ``limit`` positions of each gap.

    A gap with nothing after it repeats the last value; a gap with nothing before it stays null.
    """
    near = carry(df, keys, pos, F.col(value).isNotNull(), {"p": F.col(pos), "v": F.col(value)}, chunk, True, True)
    step = (F.col(pos) - F.col("prev_p")) / (F.col("next_p") - F.col("prev_p"))
    line = F.col("prev_v") + (F.col("next_v") - F.col("prev_v")) * step
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col(pos) - F.col("prev_p") <= limit,
                    F.when(F.col("next_p").isNull(), F.col("prev_v")).otherwise(line)))
    return near.withColumn(out, filled).drop("prev_p", "prev_v", "next_p", "next_v")


def sliding(df: DataFrame, keys: list[str], pos: str, value: str, lo: int, hi: int, chunk: int = HOUR_CHUNK) -> DataFrame:
    """Add ``_n``, ``_m``, ``_s``: count, mean and sample deviation of the values from ``lo`` to ``hi`` positions away.

    Differences of two running sums inside a chunk, so a row costs the same whatever the width. Values enter as
    deviations from the chunk's mean, which keeps the sums small; a variance that rounding alone could make is zero.
    NaN is a missing value.
    """
    group = Window.partitionBy(*keys, "_chunk")
    w, v = group.orderBy(pos), F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    spread = _spread(df, pos, lo, hi, chunk).withColumn("_v", v).withColumn("_anchor", F.avg("_v").over(group))

    def between(c: Column) -> Column:
        upto = [F.coalesce(F.sum(c).over(w.rangeBetween(Window.unboundedPreceding, at)), F.lit(0.0)) for at in (hi, lo - 1)]
        return upto[0] - upto[1]

    d = F.col("_v") - F.col("_anchor")
    sums = spread.select("*", between(F.col("_v").isNotNull().cast("double")).cast("bigint").alias("_n"), between(d).alias("_d1"),
                         between(d * d).alias("_d2")).where(F.col("_chunk") == F.col("_home"))
    spare = F.col("_d2") - F.try_divide(F.col("_d1") * F.col("_d1"), F.col("_n"))
    var = F.when(spare > F.col("_d2") * 1e-11, spare).otherwise(F.lit(0.0))
    return sums.withColumns({
        "_m": F.when(F.col("_n") > 0, F.col("_anchor") + F.try_divide("_d1", "_n")),
        "_s": F.when(F.col("_n") > 1, F.sqrt(F.try_divide(var, F.col("_n") - 1)))}).drop("_chunk", "_home", "_v", "_anchor", "_d1", "_d2")


def centred_mean(df: DataFrame, keys: list[str], pos: str, value: str, width: int, least: int | None = None,
                 out: str = "level", chunk: int = DAY_CHUNK) -> DataFrame:
    """Centred moving mean over ``width`` positions (an even width reaches one further back than ahead)."""
    least = width if least is None else least
    full = sliding(df, keys, pos, value, -(width // 2), (width - 1) // 2, chunk)
    return full.withColumn(out, F.when(F.col("_n") >= least, F.col("_m"))).drop("_n", "_m", "_s")


def rolling(df: DataFrame, keys: list[str], pos: str, value: str, width: int, shift: int, least: int,
            prefix: str = "roll", chunk: int = HOUR_CHUNK) -> DataFrame:
    """Mean and sample deviation of the ``width`` positions ending ``shift`` before each row."""
    full = sliding(df, keys, pos, value, -(shift + width - 1), -shift, chunk)
    enough = F.col("_n") >= least
    made = {f"{prefix}_mean": F.when(enough, F.col("_m")), f"{prefix}_std": F.when(enough, F.col("_s"))}
    return full.withColumns(made).drop("_n", "_m", "_s")


def latest_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``. An aggregate: hot keys combine map-side. A struct is not of fixed
    width, so the aggregate sorts within its partitions; the rows of a key never meet unreduced."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def autocovariance(df: DataFrame, keys: list[str], pos: str, value: str, max_lag: int,
                   chunk: int = HOUR_CHUNK) -> DataFrame:
    """Sums over the pairs (t, t + k) for k = 0..max_lag per series -> keys, lag, cross (products), pairs, early and late (sums of
    the pairs' first and second values).

    Each chunk carries ``max_lag`` positions of its successor, so a task holds chunk + max_lag numbers whatever the
    length of the series, and emits one row per lag. Two values at one position raise.
    """
    import numpy as np
    import pandas as pd

    p = F.col(pos)
    spread = df.where(F.col(value).isNotNull()).select(
        *keys, p.alias("_p"), F.col(value).cast("double").alias("_x"),
        F.explode(F.sequence(F.floor((p - max_lag) / chunk), F.floor(p / chunk))).alias("_chunk"))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        start = int(pdf["_chunk"].iloc[0]) * chunk
        x, have = np.zeros(chunk + max_lag), np.zeros(chunk + max_lag)
        at = (pdf["_p"].to_numpy() - start).astype(int)
        if len(np.unique(at)) < len(at):
            raise ValueError("a position holds several values; aggregate the series first")
        x[at], have[at] = pdf["_x"].to_numpy(), 1.0
        # row k of a view is the chunk shifted by k positions
        x_later, have_later = (np.lib.stride_tricks.sliding_window_view(v, chunk)[:max_lag + 1] for v in (x, have))
        own, own_have = x[:chunk], have[:chunk]
        out = pd.DataFrame({"lag": np.arange(max_lag + 1), "cross": x_later @ own, "pairs": (have_later @ own_have).astype(int),
                            "early": have_later @ own, "late": x_later @ own_have})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "lag", "cross", "pairs", "early", "late"]]

    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "lag int", "cross double", "pairs long", "early double", "late double"])
    part = spread.groupBy(*keys, "_chunk").applyInPandas(products, schema)
    return part.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("cross", "pairs", "early", "late")])


def acf(df: DataFrame, keys: list[str], pos: str, value: str, max_lag: int, chunk: int = HOUR_CHUNK) -> DataFrame:
    """Autocorrelation r_k = sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2 -> keys, lag, r.

    Sums run over the pairs that exist; a lag no pair spans has no row. Values are added up as they are, in one pass; the
    mean, which lag 0 holds, is taken out of the sums of a lag, a row each.
    """
    sums = autocovariance(df, keys, pos, value, max_lag, chunk)
    group = Window.partitionBy(*keys)
    mean = F.max(F.when(F.col("lag") == 0, F.col("early") / F.col("pairs"))).over(group)
    own = F.col("cross") - F.col("_m") * (F.col("early") + F.col("late")) + F.col("_m") * F.col("_m") * F.col("pairs")
    centred = sums.withColumn("_m", mean).withColumn("_c", own)
    total = F.max(F.when(F.col("lag") == 0, F.col("_c"))).over(group)
    return centred.withColumn("_t", total).where(F.col("pairs") > 0).select(*keys, "lag", F.try_divide("_c", "_t").alias("r"))
