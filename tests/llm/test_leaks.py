"""Leaks that cosines of single windows do not propose: items held by many rows, and items far longer than a window."""

from __future__ import annotations

import brute

from flowgrid.llm import decontaminate


def found(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_an_item_leaked_into_a_third_of_all_rows(spark):
    items = [(i, brute.prose(500 + i, 30 + i)) for i in range(20)]
    rows = [(i, brute.prose(10_000 + i, 100)) for i in range(600)]
    rows += [(1000 + i, f"{brute.prose(20_000 + i, 40 + i % 9)} {items[0][1]} {brute.prose(30_000 + i, 30)}") for i in range(300)]
    rows += [(2000 + i, f"{brute.prose(40_000 + i, 50)} {items[i][1]}") for i in range(1, 20)]
    assert found(spark, rows, items) == {(1000 + i, 0) for i in range(300)} | {(2000 + i, i) for i in range(1, 20)}


def test_items_far_longer_than_a_window(spark):
    items = [(n, brute.prose(600 + n, n)) for n in (500, 1000, 1500, 2000)] + [(i, brute.prose(700 + i, 40)) for i in range(8)]
    rows = [(i, brute.prose(10_000 + i, 300)) for i in range(40)]
    rows += [(1000 + n, f"{brute.prose(n, 90)} {items[j][1]} {brute.prose(n + 1, 200)}") for j, (n, _) in enumerate(items[:4])]
    rows += [(5000 + n, brute.edited(items[j][1], n, 9)) for j, (n, _) in enumerate(items[:4])]
    half = [(9000 + n, " ".join(items[j][1].split()[:n // 2])) for j, (n, _) in enumerate(items[:4])]
    want = {(start + n, n) for start in (1000, 5000) for n in (500, 1000, 1500, 2000)}
    assert found(spark, rows + half, items) == want


def test_no_python_workers_for_an_empty_start(spark):
    docs = spark.createDataFrame([(1, brute.prose(1, 50))], "doc_id long, text string")
    out = decontaminate.matches(docs, spark.createDataFrame([(1, brute.prose(2, 40))], "item_id long, text string"))
    assert "ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()
    none = decontaminate.matches(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 0 and none.dtypes == out.dtypes
