"""Consistent-hash ring with virtual nodes and bounded loads.

Keys hash to one of CELLS cells of a ring; virtual nodes sit on cell boundaries and own the cells up to the next one.
A cell's keys go to its owner while that shard has room; keys beyond its capacity continue clockwise to the next
shard with room. With ``slack`` 0 the capacities add up to the number of rows, so shard counts differ by one at most.

All keys of a cell share one way around the ring, so the walk needs only the counts per cell: CELLS rows at most on the
driver, whatever the data. A key's place among its cell's keys then names its shard and slot.

Nulls and edges: a null text has size 1 and checksum 0; rows with a null key share one cell; repeated rows are counted
before they are shuffled and numbered one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from flowgrid.llm.common import stored, text_of

CELLS = 1 << 16


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(first cell, shard) of every virtual node, in ring order. A taken cell passes its node on to the next one."""
    if shards * vnodes > CELLS // 2:
        raise ValueError("too many virtual nodes for the ring")
    taken: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            cell = int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest()) % CELLS
            while cell in taken:
                cell = (cell + 1) % CELLS
            taken[cell] = s
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard; with no slack exactly ``rows`` in sum, counts at most one apart."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per cell the runs (from, to, shard, first slot) of its keys' places. Owners fill first, in ring order; what
    overflows continues clockwise from its cell."""
    room, used = list(room), [0] * len(room)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    over = []

    def put(cell: int, at: int, to: int, shard: int) -> int:
        n = min(to - at, room[shard])
        if n:
            runs.setdefault(cell, []).append((at, at + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return at + n

    node = 0
    for cell in sorted(counts):
        while node + 1 < len(nodes) and nodes[node + 1][0] <= cell:
            node += 1
        own = node if nodes[node][0] <= cell else len(nodes) - 1  # before the first node the last one owns
        at = put(cell, 0, counts[cell], nodes[own][1])
        if at < counts[cell]:
            over.append((cell, at, own))
    for cell, at, own in over:
        step = 1
        while at < counts[cell]:
            at = put(cell, at, counts[cell], nodes[(own + step) % len(nodes)][1])
            step += 1
    return runs


def place(docs: DataFrame, shards: int = 16, vnodes: int = 128, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text = text_of()
    keys = stored(
        docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("at", F.xxhash64("doc_id"))
        .withColumn("cell", F.shiftrightunsigned("at", 48).cast("int")), "ring-keys")
    counts = {r[0]: r[1] for r in keys.groupBy("cell").agg(F.sum("copies")).collect()}  # at most CELLS rows
    runs = walk(counts, ring(shards, vnodes), capacities(sum(counts.values()), shards, slack))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("lo", "hi", "shard", "base")])
    plan = spark.createDataFrame([(c, r) for c, r in runs.items()], T.StructType([
        T.StructField("cell", T.IntegerType()), T.StructField("runs", T.ArrayType(run))]))
    order = Window.partitionBy("cell").orderBy("at", "doc_id", "size", "text_crc32")
    ranked = keys.withColumn("end", F.sum("copies").over(order))
    return (ranked.join(F.broadcast(plan), "cell")  # at most CELLS rows
            .withColumn("r", F.explode(F.sequence(F.col("end") - F.col("copies"), F.col("end") - 1)))
            .withColumn("run", F.filter("runs", lambda s: (s["lo"] <= F.col("r")) & (F.col("r") < s["hi"]))[0])
            .select("doc_id", "size", "text_crc32", F.col("run.shard").cast("int").alias("shard"),
                    (F.col("run.base") + F.col("r") - F.col("run.lo")).alias("slot")))
