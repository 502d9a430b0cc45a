"""Spans of pattern matches as column expressions: positions in code points, end exclusive.

``split`` gives the pieces between the matches of a pattern and ``regexp_extract_all`` the matches themselves; running
lengths of both give every position. Texts that do not match at all stop at one test.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def find(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column],
         hint: Column | None = None) -> Column:
    """Array of (start, kind, end, value) of the leftmost non-overlapping matches for whose value ``keep`` holds.
    ``hint``: a cheap test that every matching text passes."""
    between, match = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.filter(F.arrays_zip(between.alias("p"), match.alias("m")), lambda x: x["m"].isNotNull())

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("s"), F.lit(kind).alias("k"), end.alias("e"), x["m"].alias("v")))).alias("out"))

    empty = F.array().cast(SPAN)
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda acc: acc["out"])
    test = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    return F.when(test, F.filter(spans, lambda x: keep(x["v"]))).otherwise(F.array().cast(SPAN))


def merged(*kinds: Column) -> Column:
    """All spans by start, then kind as numbered."""
    return F.array_sort(F.concat(*kinds))


def listing(spans: Column, names: Sequence[str]) -> Column:
    """kind:start:end, comma-joined."""
    label = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(label, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == kind)).cast("bigint")


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < end) & (start < b["e"]))


def redact(text: Column, spans: Column, names: Sequence[str]) -> Column:
    """The text with each maximal covered run replaced by [kind of its first span]; ``spans`` sorted by start."""
    label = F.array(*[F.lit(n) for n in names])

    def add(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        part = F.when(fresh, F.concat(gap, F.lit("["), F.get(label, x["k"]), F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["parts"], F.array(part)).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = F.aggregate(spans, start, add, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
