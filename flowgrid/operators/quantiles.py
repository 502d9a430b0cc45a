"""Exact quantiles by selection in mergeable histograms.

A wanted rank is narrowed down in three scans of the source, whatever its size and however many quantiles are asked for:

1. counts in slots of equal ratio (a monotone function of the value, so no range has to be known before);
2. the same, but slots that hold a wanted rank are cut into slots of equal width between the least and the greatest value
   they hold;
3. the same, but in the second slots that hold one every value is counted by itself.

Every scan is an aggregate that combines map-side, and each histogram covers all rows, so ranks follow from it alone.
Nothing is estimated: there is no bracket that could miss and no case for small groups.

With ``fold`` the same counts are kept per fold. Counts add up, so the histogram of everything before a fold is a prefix
sum over folds of cells, and each fold narrows its own ranks in it: a source row is counted once, in its own fold, and
is never copied to later ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgrid.operators.series import attach

RATIO, WIDTH, TINY = 64, 4096, 1e-12


def _coarse(v: Column) -> Column:
    """RATIO slots for each factor of e, on both sides of zero; equal or larger values never get a smaller slot."""
    size = F.least(F.floor(F.log1p(F.abs(v) / TINY) * RATIO), F.lit(1_000_000))
    return (F.signum(v) * size).cast("int")


def _ranked(cells: DataFrame, keys: list[str], fold: bool) -> DataFrame:
    """keys, _for, _lo, _hi, _from, _upto, _m: the places that each cell's rows take among all ``_m`` rows of the folds before
    ``_for``. Cells (keys, _f, slot, _c, _lo, _hi) are disjoint ranges of values, so their ends order them."""
    if keys:
        cells = cells.repartition(*keys)  # the windows need a group's cells in one task anyway; all that follows stays there
    if fold:
        stack = (cells.withColumn("_folds", F.collect_set("_f").over(Window.partitionBy(*keys))).groupBy(*keys, "_a", "_b", "_x")
                 .agg(F.collect_list(F.struct("_f", "_c")).alias("_l"), F.first("_folds").alias("_folds"), F.min("_lo").alias("_lo"),
                      F.max("_hi").alias("_hi")))  # an entry for each fold
        earlier = F.filter("_l", lambda x: x["_f"] < F.col("_for"))
        count = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda acc, x: acc + x["_c"])
        cells = stack.select(*keys, "_l", "_lo", "_hi", F.explode("_folds").alias("_for")).withColumn("_c", count)
    else:
        cells = cells.withColumn("_for", F.lit(1))
    group = Window.partitionBy(*keys, "_for")
    upto = F.sum("_c").over(group.orderBy("_lo"))
    return cells.where("_c > 0").select(*keys, "_for", "_lo", "_hi", (upto - F.col("_c")).alias("_from"), upto.alias("_upto"),
                                        F.sum("_c").over(group).alias("_m"))


def _rank(q: float) -> Column:
    return F.lit(float(q)) * (F.col("_m") - 1)


def _holds(rank: Column) -> Column:
    return (F.col("_from") <= rank) & (rank < F.col("_upto"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float], fold: str | None = None) -> DataFrame:
    """keys and one column for each name in ``qs``: the linearly interpolated quantile of the values of a group.

    With ``fold``: keys, fold and the quantiles of all rows of the group in smaller folds; a fold with no value before it
    has no row. Nulls and NaN are missing values.
    """
    wanted = reduce(lambda a, b: a | b, [_holds(end(_rank(q))) for q in qs.values() for end in (F.floor, F.ceil)])
    v = F.col(value).cast("double") + 0.0
    src = df.select(*keys, (F.col(fold) if fold else F.lit(0)).alias("_f"), F.when(~F.isnan(v), v).alias("_v")).withColumn("_a", _coarse(F.col("_v")))

    def cells(rows: DataFrame, b: Column, x: Column) -> DataFrame:
        return rows.select(*keys, "_f", "_v", "_a", b.cast("int").alias("_b"), x.cast("double").alias("_x")).groupBy(*keys, "_f", "_a", "_b", "_x").agg(
            F.count("_v").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))

    def opened(counted: DataFrame) -> DataFrame:
        """The source with the ranges of values that hold a wanted rank: two for each fold and quantile at most."""
        held = _ranked(counted, keys, bool(fold)).where(wanted)
        ranges = held.groupBy(*keys).agg(F.collect_set(F.struct("_lo", "_hi")).alias("_open"), F.min("_lo").alias("_least"), F.max("_hi").alias("_most"))
        inside = F.filter("_open", lambda r: F.col("_v").between(r["_lo"], r["_hi"]))
        at = F.when(F.col("_v").between(F.col("_least"), F.col("_most")), F.get(inside, F.lit(0)))
        return attach(src, ranges, keys).withColumn("_at", at)

    second = opened(cells(src, F.lit(0), F.lit(None)))
    share = F.coalesce(F.try_divide(F.col("_v") - F.col("_at._lo"), F.col("_at._hi") - F.col("_at._lo")), F.lit(0.0))
    fine = F.when(F.col("_at").isNotNull(), F.least(F.floor(share * WIDTH), F.lit(WIDTH - 1)))
    third = opened(cells(second, fine, F.lit(None)))
    under = F.size(F.filter("_open", lambda r: r["_hi"] < F.col("_v")))  # rows between open ranges stay apart
    below = F.when(F.col("_v") < F.col("_least"), 0).when(F.col("_v") > F.col("_most"), F.size("_open")).otherwise(under)
    found = _ranked(cells(third, below, F.when(F.col("_at").isNotNull(), F.col("_v"))), keys, bool(fold)).where(wanted)

    def pick(q: float) -> Column:
        low, high = (F.max(F.when(_holds(end(_rank(q))), F.col("_lo"))) for end in (F.floor, F.ceil))
        return low + (high - low) * F.max(_rank(q) - F.floor(_rank(q)))

    out = found.groupBy(*keys, "_for").agg(*[pick(q).alias(n) for n, q in qs.items()])
    return out.withColumnRenamed("_for", fold) if fold else out.drop("_for")


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str = "q", fold: str | None = None) -> DataFrame:
    """One quantile; see ``exact_quantiles``."""
    return exact_quantiles(df, keys, value, {out: q}, fold)
