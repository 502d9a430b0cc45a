"""Keyed stream state: micro-batches equal one batch, timers bound the state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flowgrid.streaming import streams

T0 = dt.datetime(2024, 1, 1)


def stream_of(spark, tmp_path, schema, batches):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return streams.source(spark, str(tmp_path / "in"), schema, files_per_batch=1)


def hour(h):
    return T0 + dt.timedelta(hours=h)


def test_newest_versions_come_once_and_state_ends_with_its_timer(spark, tmp_path):
    schema = "k string, v long, ts timestamp_ntz"
    batches = [[("a", 1, hour(0)), ("a", 3, hour(0)), ("b", 7, hour(0))], [("a", 2, hour(1)), ("b", 9, hour(1)), ("c", 1, hour(30))],
               [("c", 5, hour(30))], [("a", 2, hour(30))]]
    stream = stream_of(spark, tmp_path, schema, batches)
    streams.run(streams.newest(stream, ["k"], "v", "ts", "10 hours"), str(tmp_path / "cp"), str(tmp_path / "out"))
    got = sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # version 2 of a is older than 3 in the second micro-batch; in the last one the timer has dropped a's state
    assert got == [("a", 2), ("a", 3), ("b", 7), ("b", 9), ("c", 1), ("c", 5)]


def test_runs_across_micro_batches_equal_one(spark, tmp_path):
    schema = "k string, h long, v double, ts timestamp_ntz"
    rows = [(k, h, float(v), hour(h)) for k, vs in (("a", "1112233331"), ("b", "5555555555"), ("c", "12")) for h, v in enumerate(vs)]
    rows = [r for r in rows if r[:2] != ("b", 4)]  # a gap ends a run
    want = {("a", 0): 3, ("a", 3): 2, ("a", 5): 4, ("a", 9): 1, ("b", 0): 4, ("b", 5): 5, ("c", 0): 1, ("c", 1): 1}
    for name, cuts in (("one", [99]), ("three", [2, 7, 99]), ("many", [1, 2, 3, 5, 6, 99])):
        parts, low = [], -1
        for c in cuts:
            parts.append([r for r in rows if low < r[1] <= c])
            low = c
        folder = tmp_path / name
        folder.mkdir()
        stream = stream_of(spark, folder, schema, [p for p in parts if p])
        streams.run(streams.run_starts(stream, ["k"], "h", "v", "ts"), str(folder / "cp"), str(folder / "out"))
        got = spark.read.parquet(str(folder / "out")).groupBy("k", "run_start").agg(F.count("*").alias("n")).collect()
        assert {(r.k, r.run_start): r.n for r in got} == want, name


def test_a_row_behind_its_run_has_no_start(spark, tmp_path):
    stream = stream_of(spark, tmp_path, "k string, h long, v double, ts timestamp_ntz", [[("a", 5, 1.0, hour(5))], [("a", 4, 1.0, hour(4)), ("a", 6, 1.0, hour(6))]])
    streams.run(streams.run_starts(stream, ["k"], "h", "v", "ts"), str(tmp_path / "cp"), str(tmp_path / "out"))
    assert {r.h: r.run_start for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {4: None, 5: 5, 6: 5}
