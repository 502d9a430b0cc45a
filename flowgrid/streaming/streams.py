"""Structured Streaming twins of landing, dedupe, hourly aggregation and the gate.

All of them run with ``availableNow`` - process what is there, then stop - and keep their progress in a checkpoint
folder on shared storage, so a restarted query continues where the lost one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from flowgrid.functions.timefns import hour_ts, utc_instant
from flowgrid.operators.series import latest_wins
from flowgrid.sources import tables as T


def source(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """File stream of a folder, or of one file of a folder, with a declared schema.

    The cap bounds one micro-batch, not the data.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if T.is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run(df: DataFrame, checkpoint: str, path: str | None = None, each: Callable | None = None,
        mode: str = "append") -> None:
    """Drive a stream to the end of the available input, into parquet or through a batch function."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(each).start() if each else w.format("parquet").option("path", path).start()
    q.awaitTermination()


def bronze(stream: DataFrame, checkpoint: str, path: str, batch_id: str) -> None:
    """Append-only bronze: the checkpoint plays the role of the batch-id anti-join."""
    run(T.with_lineage(stream, batch_id), checkpoint, path)


def exact_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop re-deliveries of the same row that arrive within the delay."""
    timed = stream.withColumn("_at", utc_instant(ts)).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_at")


def latest_version(spark: SparkSession, stream: DataFrame, checkpoint: str, path: str, keys: list[str],
                   order: list[str], partition_by: str) -> None:
    """Keep the newest version of every key: reduce the micro-batch, then upsert where it is newer."""
    def each(batch: DataFrame, _epoch: int) -> None:
        best = latest_wins(batch, keys, order)
        if T.exists(spark, path):
            old = spark.read.parquet(path).withColumn(partition_by, F.col(partition_by).cast("string"))
            touched = old.join(F.broadcast(best.select(partition_by).distinct()), partition_by, "left_semi")
            best = latest_wins(touched.unionByName(best, allowMissingColumns=True), keys, order)
        T.upsert(spark, best, path, keys, partition_by)
    run(stream, checkpoint, each=each, mode="update")


def newest(stream: DataFrame, keys: list[str], order: str, ts: str, keep: str = "2 days") -> DataFrame:
    """Versions of rows that are newer, by ``order``, than all versions of their key seen before, across micro-batches.

    The newest ``order`` of a key is keyed state; stored rows are not read again. A timer drops it once the watermark has
    passed ``keep`` after the newest version's ``ts``; versions older than the watermark are dropped as late. ``keep`` must
    therefore cover the time over which versions of a key arrive. Equal orders count as seen.
    """
    rank = T_.StructType([T_.StructField("best", stream.schema[order].dataType)])
    schema = stream.schema

    def each(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = state.get[0] if state.exists else None
        found, last = None, 0
        for frame in frames:
            last = max(last, int(frame["_ms"].max()))
            top = frame.loc[frame[order].idxmax()] if frame[order].notna().any() else None
            if top is not None and (best is None or top[order] > best):
                best, found = top[order], frame.loc[[top.name], list(schema.names)]
        if found is not None:
            state.update((best.item() if hasattr(best, "item") else best,))
            yield found
        if state.exists:
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1)

    timed = stream.withColumn("_at", utc_instant(ts)).withWatermark("_at", keep).withColumn("_ms", F.unix_millis("_at"))
    return timed.groupBy(*keys).applyInPandasWithState(each, schema, rank, "append", "EventTimeTimeout")


def run_starts(stream: DataFrame, keys: list[str], pos: str, value: str, ts: str, keep: str = "2 days") -> DataFrame:
    """keys, ``pos``, ``value`` and ``run_start``, the position where the run of equal values one position apart began, across
    micro-batches. The end of a series' last run is keyed state, dropped by a timer ``keep`` after it. Positions must not
    decrease from one micro-batch to the next; a row that comes too late for that has no ``run_start``.
    """
    field = lambda n, kind: T_.StructField(n, kind)
    known = [stream.schema[c] for c in (*keys, pos, value)]
    end = T_.StructType([field("at", T_.LongType()), field("value", T_.DoubleType()), field("start", T_.LongType())])
    schema = T_.StructType([*known, field("run_start", T_.LongType())])

    def each(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values(pos, kind="stable")  # one series' share of a micro-batch
        at, old, start = state.get if state.exists else (None, None, None)
        late = rows[pos] <= at if at is not None else pd.Series(False, rows.index)
        fresh = rows[~late]
        starts = []
        for p, v in zip(fresh[pos].tolist(), fresh[value].tolist(), strict=True):
            same = at is not None and p - at == 1 and v == old
            start = start if same else p
            at, old = p, v
            starts.append(start)
        out = pd.concat([fresh.assign(run_start=starts), rows[late].assign(run_start=None)])
        out["run_start"] = out["run_start"].astype("Int64")
        if starts:
            state.update((int(at), None if old is None or pd.isna(old) else float(old), int(start)))
        state.setTimeoutTimestamp(max(int(rows["_ms"].max()), state.getCurrentWatermarkMs()) + 1)
        yield out[list(schema.names)]

    timed = stream.withColumn("_at", utc_instant(ts)).withWatermark("_at", keep).withColumn("_ms", F.unix_millis("_at"))
    return timed.groupBy(*keys).applyInPandasWithState(each, schema, end, "append", "EventTimeTimeout")


def hourly(stream: DataFrame, keys: list[str], ts: str, value: str, delay: str = "1 hour",
           kind: str = "decimal(28,9)") -> DataFrame:
    """Closed hourly windows per series; a window is final once the watermark has passed its end. Values are added as
    ``kind``, so that the order of arrival cannot change a sum."""
    timed = stream.withColumn("_at", utc_instant(ts)).withWatermark("_at", delay)
    closed = timed.groupBy(F.window("_at", "1 hour"), *keys).agg(
        F.sum(F.col(value).cast(kind)).alias("total"), F.count("*").alias("n"))
    start = hour_ts(F.floor(F.unix_seconds("window.start") / 3600).cast("int"))
    return closed.select(*keys, start.alias("ts"), F.col("total").cast("double").alias("total"), "n")


def gate(spark: SparkSession, stream: DataFrame, checkpoint: str, path: str, tag: Callable[[DataFrame], DataFrame],
         day: str = "p_day", reach: int = 1, accept: Callable[[DataFrame], bool] = lambda _: True) -> None:
    """Row rules over a stream, with the outcome that one batch would have, however the input is split.

    Micro-batches are kept by day and batch. Each one tags again the days it touches and ``reach`` days around them,
    read from what has been kept so far, and replaces those days of the table at ``path``, where ``reason`` is null
    for clean rows. Duplicates and stuck runs across micro-batches thus count, and a replayed one changes nothing. When
    ``accept`` refuses, the days stay as they were until a later batch touches them.
    """
    kept = f"{path.rstrip('/')}__kept"

    def each(batch: DataFrame, epoch: int) -> None:
        T.replace_partitions(batch.withColumn("_epoch", F.lit(epoch)), kept, day, "_epoch")
        days = [r[0] for r in batch.select(F.to_date(day)).distinct().collect()]  # bounded by the calendar
        if not days:
            return
        near = lambda k: [str(d + timedelta(days=i)) for d in days for i in range(-k, k + 1)]
        rows = spark.read.schema(batch.schema).parquet(kept).select(*batch.columns).where(F.col(day).isin(near(2 * reach)))
        tagged = tag(rows).where(F.col(day).isin(near(reach))).persist()
        if accept(tagged):
            T.replace_partitions(tagged, path, day)
        tagged.unpersist()
    run(stream, checkpoint, each=each)
