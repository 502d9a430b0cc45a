"""Helpers of the corpus operators: stored intermediates, arrow columns, key hashes."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.session import shared_folder


#: Rows and bytes of text that Python gets at once, so that very long documents do not add up in a worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608")}


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python once per context; they need not share the driver's folders. Arrow
    batches that the session has left at their defaults are bounded."""
    for key, (default, bound) in BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, bound)
    context = spark.sparkContext
    if getattr(context, "_flowgrid_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="flowgrid-"), "flowgrid"), "zip", root, "flowgrid"))
    context._flowgrid_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the folder all executors share and read back: lineage ends there and nothing is computed twice."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def tidy(spark: SparkSession) -> None:
    """Delete the shuffle files of finished jobs: Spark does so when the driver collects its garbage, which a roomy driver
    may not do before the query ends."""
    gc.collect()
    spark._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing reads any more, what was made of them is stored itself, and the
    shuffle files behind them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tidy(tables[0].sparkSession)


def text_of(name: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """128-bit identity of a text. Operators whose result depends on the text alone join on it, so null or repeated
    ids do no harm."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(7)).alias("b"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def gathered(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in batches of about ``rows``; for columns of a few bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def trimmed(run):
    """``run``, after which the Python worker gives freed memory back: it stays alive for the tasks that follow."""
    def then(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return then


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with further columns behind its own, whatever those are called."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])
