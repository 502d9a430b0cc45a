"""Parquet tables: pruned scans, appends with lineage, idempotent ingestion, upserts by partition.

One writer per table is assumed. A rewrite goes to a staging folder first and only then replaces the touched
partitions, so losing an executor - or the job - midway leaves the old partitions in place.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flowgrid.schemas import FEEDS, struct

ONE_DAY = timedelta(days=1)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) on whatever storage the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isFile())


def scan(spark: SparkSession, path: str, where: str | Column | None = None) -> DataFrame:
    """Read a table; the predicate reaches the parquet reader."""
    df = spark.read.parquet(path)
    return df if where is None else df.where(where)


def ts_range(column: str, start: datetime, end: datetime) -> Column:
    """start <= column < end on the raw column, so that row-group statistics can prune."""
    lit = lambda v: F.lit(v.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (F.col(column) >= lit(start)) & (F.col(column) < lit(end))


def source_window(feeds: dict[str, DataFrame], start: date, end: date, now_local: datetime) -> dict[str, DataFrame]:
    """Slices of the four feeds for the complete days start..end.

    Forecasts and calendar reach two days further so that "tomorrow" is covered, and a vintage issued after
    ``now_local`` is never taken.
    """
    lo = datetime(start.year, start.month, start.day)
    hi = datetime(end.year, end.month, end.day) + ONE_DAY
    out = {}
    for name, df in feeds.items():
        reach = hi + 2 * ONE_DAY if name in ("weather_fcst", "calendar") else hi
        column = FEEDS[name][2]
        if name == "calendar":
            out[name] = df.where((F.col(column) >= F.lit(lo.date())) & (F.col(column) < F.lit(reach.date())))
        else:
            out[name] = df.where(ts_range(column, lo, reach))
        if name == "weather_fcst":
            now = F.lit(now_local.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
            out[name] = out[name].where(F.col("forecast_issued_local") <= now)
    return out


# file name of each feed in a CSV drop
CSV_FILES = {"consumption": "consumption.csv", "weather_obs": "weather_observations.csv",
             "weather_fcst": "weather_forecasts.csv", "calendar": "calendar.csv"}


def csv_feeds(spark: SparkSession, folder: str, schemas: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The four feeds as CSV with a header, read with declared schemas and no inference pass."""
    ddl = schemas or {n: FEEDS[n][0] for n in FEEDS}
    return {n: spark.read.schema(struct(ddl[n])).option("header", True).csv(f"{folder}/{f}")
            for n, f in CSV_FILES.items()}


def parquet_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in FEEDS}


def balanced(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Bring the rows of a folder together before a partitioned write, splitting folders that are too big for a task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    balanced(df, partition_by).write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace data and schema of a table that ``df`` does not read."""
    balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *(partition_by or [])).parquet(path)


def replace_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write the partitions of ``df``, in place of those with the same names: a repeated step leaves one copy."""
    (balanced(df, list(partition_by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def new_batch_id(end: date) -> str:
    return f"{end:%Y%m%d}-{uuid.uuid4().hex[:8]}"


def with_lineage(df: DataFrame, batch_id: str, landed_at: Column | None = None) -> DataFrame:
    return df.withColumn("_batch_id", F.lit(batch_id)).withColumn(
        "_landed_at", F.current_timestamp() if landed_at is None else landed_at)


def new_batches(landing: DataFrame, bronze: DataFrame | None, ingested_at: Column | None = None) -> DataFrame:
    """Landing rows whose batch is not in bronze yet, stamped with one ingestion time."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    fresh = landing
    if bronze is not None:
        fresh = landing.join(bronze.select("_batch_id").distinct(), "_batch_id", "left_anti")
    return fresh.withColumn("_ingested_at", stamp)


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert result: source rows replace target rows with the same key; new columns are added by name."""
    keep = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return keep.unionByName(source, allowMissingColumns=True)


def struct_union(known: StructType, added: StructType) -> StructType:
    """The columns of a table and those that a batch adds; a column of both has the batch's type."""
    kinds = {f.name: f for f in added.fields}
    return StructType([StructField(f.name, kinds.pop(f.name, f).dataType) for f in known.fields] + list(kinds.values()))


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: list[str], partition_by: str) -> bool:
    """Upsert into a parquet table partitioned by ``partition_by``, which must be a function of the key.

    The batch is written out once, so its plan runs once however often it is used below. Only the partitions it touches
    are read and rewritten; the semi join on them prunes folders at run time, and its side is broadcast only if the
    values are days, which the calendar bounds. Two rows of a batch with one key raise. Both sides are read with their
    declared columns; a column that only the batch has is added as null. Returns False when the batch is empty.
    """
    stage = f"{path.rstrip('/')}__staging/{uuid.uuid4().hex}"
    overwrite(source, f"{stage}/batch")
    batch = spark.read.schema(source.schema).parquet(f"{stage}/batch")
    some = not batch.isEmpty()
    if some and not duplicate_keys(batch, keys).isEmpty():
        raise ValueError(f"the batch holds several rows for one key ({', '.join(keys)})")
    if some and not exists(spark, path):
        append(batch, path, [partition_by])
    elif some:
        known = spark.read.parquet(path).schema
        wider = struct_union(known, source.schema)
        target = spark.read.schema(wider).parquet(path)
        parts = batch.select(partition_by).distinct()
        days = parts.where(F.col(partition_by).cast("string").try_cast("date").isNull()).isEmpty()
        touched = target.join(F.broadcast(parts) if days else parts, partition_by, "left_semi")
        overwrite(merged(touched, batch, keys), f"{stage}/merged")
        (balanced(spark.read.parquet(f"{stage}/merged"), [partition_by]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    fs, staged = _file_system(spark, stage)
    fs.delete(staged, True)
    return some


def high_water(frames: list[DataFrame], day: Column, keys: list[str] | None = None) -> DataFrame:
    """Newest landed day (per series): max over tables of the newest day each holds."""
    keys = keys or []
    parts = [f.groupBy(*keys).agg(F.max(day).alias("d")) for f in frames]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*keys).agg(F.max("d").alias("high_water"))


def copy_window(src: DataFrame, column: str | None, latest: DataFrame, days: int) -> DataFrame:
    """The last ``days`` days of a table (whole when it has no window column); ``latest`` holds ``max_ts``."""
    if column is None:
        return src
    start = F.date_trunc("day", latest.select("max_ts").scalar()).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(days))
    return src.where(F.col(column) >= start)


def watermark_slice(bronze: DataFrame, silver: DataFrame | None, column: str = "_ingested_at") -> DataFrame:
    """Bronze rows newer than silver: a failed batch is validated again together with the next one."""
    if silver is None:
        return bronze
    seen = silver.agg(F.max(column).alias("m")).select("m").scalar()
    return bronze.where(seen.isNull() | (F.col(column) > seen))


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, name: str, ddl: str) -> None:
    """Create an empty parquet table with a declared schema."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key assertion: the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
