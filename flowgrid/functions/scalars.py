"""Null-preserving scalar expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def above(x: Column | str, knot: float) -> Column:
    """(x - knot)+ that keeps null (``greatest`` alone would turn null into 0)."""
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(x - F.lit(float(knot)), F.lit(0.0)))


def below(x: Column | str, knot: float) -> Column:
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(float(knot)) - x, F.lit(0.0)))


def any_null(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def outside(x: Column | str, lo: float, hi: float) -> Column:
    """Outside the closed range; a null is not outside."""
    x = col(x)
    return F.coalesce(~x.between(float(lo), float(hi)), F.lit(False))


def ratio(num: Column, den: Column) -> Column:
    """num / den, null when the denominator is zero (ANSI mode would raise)."""
    return F.try_divide(num, den)


def pct_error(pred: Column | str, actual: Column | str) -> Column:
    """Absolute percentage error; null unless the actual is positive."""
    p, a = col(pred), col(actual)
    return F.when(a > 0, F.abs(p - a) / a * 100)


def fourier(x: Column | str, period: float, harmonic: int = 1) -> tuple[Column, Column]:
    """(sin, cos) of 2 pi k x / period."""
    angle = F.lit(2 * math.pi * harmonic) * col(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def flag(condition: Column) -> Column:
    """0/1 double; unknown counts as 0."""
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first true condition."""
    out = None
    for condition, label in cases:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default)


def bin_right(x: Column | str, lo: float, width: float) -> Column:
    """Index of the half-open bin (lo + i*w, lo + (i+1)*w] holding x."""
    return (F.ceil((col(x) - F.lit(float(lo))) / F.lit(float(width))) - 1).cast("int")
