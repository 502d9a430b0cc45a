"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

A string of ``LENGTH`` bytes is repeated if it starts at two places of the corpus. Every such string holds an anchor: in
each run of W = LENGTH - Q + 1 neighbouring Q-grams the ones of least hash are anchors (winnowing), so equal strings have
equal anchors at equal offsets. Anchors are the sampled suffixes; an anchor's string may begin o = 0 .. W-1 bytes before.

Buckets are refined by offset. A node is (anchor, interval of o); its bucket identifiers are hashes of the bytes that all
strings of the node share (their meet) and of those that any of them touches (their join). A node whose meet is alone
dies; nodes with the same join are removed whole, and one of them stays as a witness while others in the bucket are
undecided; these are split in four and refined again on the identifiers of the smaller intervals, until single strings
decide. Buckets of at most LOCAL nodes are finished inside one task by the same recursion on their bytes; larger ones
are split, counted and dealt anew, so a passage of a third of all rows never meets in one task.

Results depend on the text alone and are joined back by its 128-bit identity; equal texts of LENGTH bytes or more
remove each other entirely. Texts that hold no live bucket are filtered out before texts are shuffled, by a bitmap of
fixed size that lets some others through but drops none that is needed.

Nulls and edges: a null text is empty; texts below LENGTH bytes keep all bytes; strings are judged on the input and may
overlap, also within one text; repeated rows are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.llm.common import discard, stored, text_key, text_of

LENGTH, W = 400, 256
LOCAL, BITS = 128, 22
Q = LENGTH - W + 1
SPLIT = 4
KEY = "key struct<a:bigint,b:bigint>"
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _sliding(x: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of every w neighbours: prefix and suffix runs within blocks of w."""
    op, fill = (np.minimum, np.iinfo(x.dtype).max) if least else (np.maximum, 0)
    n = len(x)
    pad = np.full((-n) % w, fill, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n - w + 1], ahead[w - 1:n])


def powers(n: int) -> list[np.ndarray]:
    """BASE and its inverse modulo 2^64 to the powers 0 .. n-1, kept for the longest text seen."""
    if len(_powers[0]) < n:
        for i, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            _powers[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, b, np.uint64))])
    return [p[:n] for p in _powers]


def anchors(data: np.ndarray) -> np.ndarray:
    """Positions of the anchor Q-grams of a byte array."""
    n = len(data)
    if n < LENGTH:
        return np.array([], np.int64)
    up, down = powers(n)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
    gram = (total[Q:] - total[:-Q]) * down[:n - Q + 1]  # one hash for one content wherever it stands
    gram = (gram ^ gram >> np.uint64(29)) * MIX
    gram ^= gram >> np.uint64(32)
    least = _sliding(gram, W, True)
    reach = np.concatenate([np.zeros(W - 1, np.uint64), least, np.zeros(W - 1, np.uint64)])
    return np.flatnonzero(_sliding(reach, W, False) == gram)


def pieces(x: int, n: int, size: int, lo: int) -> tuple[tuple[int, int] | None, tuple[int, int] | None]:
    """(meet, join) of the strings starting lo .. lo+size-1 bytes before anchor x in a text of n bytes. A meet that does
    not fit is None: then no string of the node does. A join that does not fit is None: then some string does not."""
    hi = lo + size - 1
    meet = (x - lo, x - hi + LENGTH) if x >= lo and x - hi + LENGTH <= n else None
    join = (x - hi, x - lo + LENGTH) if x >= hi and x - lo + LENGTH <= n else None
    return meet, join


def _h(data: bytes) -> int:
    """Half an identifier: a join is told by its meet's and its own, 128 bits together."""
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _rows(key: pa.Array, cols: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, *(pa.array(v, kinds[k]) for k, v in cols.items())], names=["key", *cols])


KINDS = {"pos": pa.int32(), "lo": pa.int32(), "size": pa.int32(), "meet": pa.int64(), "whole": pa.int64(),
         "bytes": pa.binary(), "at": pa.int32(), "start": pa.int32(), "end": pa.int32()}
NODE = f"{KEY}, meet bigint, pos int, lo int, size int, at int, bytes binary"
SPAN = f"{KEY}, start int, end int"


def _rows(key: pa.Array, **columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, *(pa.array(v, KINDS[k]) for k, v in columns.items())], names=["key", *columns])


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, pos, meet and join identifiers of every anchor; no join where some string would leave the text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            doc, pos, meets, joins = [], [], [], []
            for i, text in enumerate(part.column(1)):
                data = text.as_py()
                for x in anchors(np.frombuffer(data, np.uint8)).tolist():
                    meet, join = pieces(x, len(data), W, 0)
                    doc.append(i)
                    pos.append(x)
                    meets.append(_h(data[slice(*meet)]))
                    joins.append(None if join is None else _h(data[slice(*join)]))
            yield _rows(part.column(0).take(pa.array(doc, pa.int64())), pos=pos, meet=meets, whole=joins)


def _surroundings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the bytes that may matter around each anchor in question out of its text."""
    for batch in batches:
        for row in range(batch.num_rows):
            data, places = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
            cut = [(p["pos"], max(0, p["pos"] - W + 1), p["meet"]) for p in places]
            yield _rows(pa.array([batch.column(0)[row].as_py()] * len(cut), batch.schema.field(0).type),
                        meet=[m for _, _, m in cut], pos=[x for x, _, _ in cut], lo=[0] * len(cut), size=[W] * len(cut),
                        at=[x - a for x, a, _ in cut], bytes=[data[a:x + LENGTH] for x, a, _ in cut])


def finish(nodes: list[tuple[int, bytes]], lo: int, size: int, out: list[tuple[int, int, int]]) -> None:
    """Decides a bucket inside a task. nodes: (anchor place in its bytes, bytes); out: (node, lo, size) removed whole."""
    def part(members: list[int], lo: int, size: int) -> None:
        buckets: dict[bytes, list[int]] = {}
        for i in members:
            at, data = nodes[i]
            meet, _ = pieces(at, len(data), size, lo)
            if meet is not None:
                buckets.setdefault(data[slice(*meet)], []).append(i)
        for bucket in buckets.values():
            if len(bucket) < 2:
                continue
            joins: dict[bytes, list[int]] = {}
            undecided = []
            for i in bucket:
                at, data = nodes[i]
                _, join = pieces(at, len(data), size, lo)
                if join is None:
                    undecided.append(i)
                else:
                    joins.setdefault(data[slice(*join)], []).append(i)
            witnesses = []
            for same in joins.values():
                if len(same) > 1:
                    out.extend((i, lo, size) for i in same)
                    witnesses.append(same[0])
                else:
                    undecided += same
            if size > 1 and undecided:
                step = size // SPLIT
                for low in range(lo, lo + size, step):
                    part(undecided + witnesses, low, step)

    part(list(range(len(nodes))), lo, size)


def _finish_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of whole buckets, which arrive sorted by identifier and interval."""
    bucket, rows = None, []
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def decide() -> pa.RecordBatch | None:
        out: list[tuple[int, int, int]] = []
        finish([(r[4], r[5]) for r in rows], bucket[1], bucket[2], out)
        found: dict[int, tuple[int, int]] = {}  # strings of one anchor start within W < LENGTH bytes, so they overlap
        for i, lo, size in out:
            low, high = found.get(i, (lo, lo + size))
            found[i] = min(low, lo), max(high, lo + size)
        if found:
            return _rows(pa.array([rows[i][0] for i in found], kind), start=[rows[i][1] - high + 1 for i, (_, high) in found.items()],
                         end=[rows[i][1] - low + LENGTH for i, (low, _) in found.items()])
        return None

    for batch in batches:
        for key, meet, pos, lo, size, at, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != (meet, lo, size):
                if rows and (done := decide()) is not None:
                    yield done
                bucket, rows = (meet, lo, size), []
            rows.append((key, pos, lo, size, at, data))
    if rows and (done := decide()) is not None:
        yield done


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Splits nodes in four and names the buckets of the parts. Identifiers carry the interval, so that only strings
    at equal offsets from equal anchors meet. A part without any string inside the text is dropped."""
    for batch in batches:
        own, cols = [], {k: [] for k in ("meet", "pos", "lo", "size", "at", "bytes", "whole")}
        for i, (pos, lo, size, at, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 7)), strict=True)):
            part = size // SPLIT
            for low in range(lo, lo + size, part):
                meet, join = pieces(at, len(data), part, low)
                if meet is None:
                    continue
                tag = b"%d/%d:" % (low, part)
                own.append(i)
                for name, v in (("meet", _h(tag + data[slice(*meet)])), ("pos", pos), ("lo", low), ("size", part), ("at", at),
                                ("bytes", data), ("whole", None if join is None else _h(tag + data[slice(*join)]))):
                    cols[name].append(v)
        yield _rows(batch.column(0).take(pa.array(own, pa.int64())), **cols)


def _removed(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(bytes removed, maximal runs, SHA-256 of the rest)."""
    kept, at, runs, gone = hashlib.sha256(), 0, 0, 0
    last = -1
    for a, b in sorted(spans):
        if a > last:
            runs += 1
            kept.update(data[at:a])
            gone += b - a
            at = last = b
        elif b > last:
            gone += b - last
            at = last = b
    kept.update(data[at:])
    return gone, runs, kept.hexdigest()


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_removed(text.as_py(), [(s["start"], s["end"]) for s in spans.as_py()])
               for text, spans in zip(batch.column(1), batch.column(2), strict=True)]
        gone, runs, sha = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                                          pa.array(sha, pa.string())], names=["key", "gone", "runs", "sha"])


def _only(keys: DataFrame):
    """A filter of (key, text) batches to the given keys and a few others: a bitmap of 2^BITS bits."""
    words = keys.groupBy(F.expr(f"(key.a & {(1 << BITS) - 1}L) div 64").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(key.a & 63L AS int))"))).collect()  # at most 2^(BITS-6) rows
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    for w, bits in words:
        bitmap[w] = bits
    shipped = keys.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column(0).field(0).to_numpy(zero_copy_only=False)
            slot = a & ((1 << BITS) - 1)
            yield batch.filter(pa.array(shipped.value[slot // 64] >> (slot % 64) & 1 == 1))
    return run


def _decided(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(removed whole, still in question, tables that both read) of the stored ``nodes`` (key, meet, pos, whole, ..), which
    are discarded, by counts over the corpus: buckets alone die, joins that repeat are whole; one witness of each stays
    where its bucket holds undecided nodes."""
    meets = stored(nodes.groupBy("meet").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("meet"), f"{name}-meets")
    alive = stored(nodes.join(meets, "meet"), f"{name}-alive")
    discard(nodes, meets)
    joins = stored(alive.where("whole IS NOT NULL").groupBy("meet", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "pos")).alias("w")).where("n > 1"), f"{name}-joins")
    seen = alive.join(joins, ["meet", "whole"], "left")
    whole = seen.where("n IS NOT NULL")
    asked = stored(seen.where("n IS NULL").select("meet").distinct(), f"{name}-asked")
    open_ = seen.where((F.col("n").isNull()) | (F.struct("key", "pos") == F.col("w")))
    return whole, open_.join(asked, "meet", "left_semi").select(*nodes.columns), [alive, joins, asked]


def removals(docs: DataFrame, copied: DataFrame) -> DataFrame:
    """key (text identity), gone, runs, sha of the rest, of every distinct text that loses bytes and is not ``copied``
    (key): those lose all."""
    rows = docs.select(text_key(text_of()).alias("key"), text_of().cast("binary").alias("text")).where(
        F.octet_length("text") >= LENGTH)
    first = stored(rows.mapInArrow(_scan, f"{KEY}, pos int, meet bigint, whole bigint"), "anchors")
    whole, asked, used = _decided(first, "anchors")
    spans = [stored(whole.join(copied, "key", "left_anti").select(
        "key", (F.col("pos") - W + 1).alias("start"), (F.col("pos") + LENGTH).alias("end")), "whole")]
    places = stored(asked.groupBy("key").agg(F.collect_set(F.struct("pos", "meet")).alias("places")), "places")  # of one text
    discard(*used)
    keys = stored(places.select("key").union(spans[0].select("key")).distinct(), "keys")
    # texts meet their places where their copies meet each other: they are shuffled here and for the cut, not in between
    both = rows.mapInArrow(_only(keys), f"{KEY}, text binary").select(
        "key", "text", F.lit(None).cast(places.schema["places"].dataType).alias("places")).union(
        places.select("key", F.lit(None).cast("binary"), "places"))
    texts = stored(both.groupBy("key").agg(F.first("text", True).alias("text"), F.first("places", True).alias("places"),
                                           F.count("text").alias("copies")), "texts")
    discard(places, keys)
    nodes, used = texts.where("places IS NOT NULL").select("key", "text", "places").mapInArrow(_surroundings, NODE), []
    size = W
    while True:
        nodes = stored(nodes, f"nodes-{size}")
        discard(*used)
        counts = nodes.groupBy("meet").agg(F.count(F.lit(1)).alias("n"))
        large = stored(counts.where(F.col("n") > LOCAL).select("meet"), f"large-{size}")
        spans.append(stored(nodes.join(large, "meet", "left_anti").select(*nodes.columns).repartition("meet")
                            .sortWithinPartitions("meet", "lo").mapInArrow(_finish_buckets, SPAN), f"spans-{size}"))
        if size == 1 or large.limit(1).count() == 0:
            discard(nodes, large)
            break
        size //= SPLIT
        parts = stored(nodes.join(large, "meet", "left_semi").select(*nodes.columns)
                       .mapInArrow(_refine, f"{NODE}, whole bigint"), f"parts-{size}")
        discard(nodes, large)
        whole, nodes, used = _decided(parts, f"parts-{size}")
        # the strings starting lo .. lo+size-1 bytes before the anchor cover its join
        spans.append(stored(whole.select("key", (F.col("pos") - F.col("lo") - size + 1).alias("start"),
                                         (F.col("pos") - F.col("lo") + LENGTH).alias("end")), f"whole-{size}"))
        nodes = nodes.drop("whole")
    every = spans[0]
    for s in spans[1:]:
        every = every.union(s)
    of = every.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one text
    out = stored(texts.where("copies = 1").select("key", "text").join(of, "key").select("key", "text", "spans")
                 .mapInArrow(_cut, f"{KEY}, gone bigint, runs bigint, sha string"), "removed")
    discard(texts, *spans)
    return out


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    text = text_of()
    rows = docs.select("doc_id", text_key(text).alias("key"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       F.sha2(text.cast("binary"), 256).alias("full_sha"))
    copied = stored(rows.where(F.col("n_bytes") >= LENGTH).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "key", F.lit(True).alias("copied")), "copied")
    removed = removals(docs, copied)
    found = stored(removed.join(copied, "key", "full_outer"), "removals")
    discard(copied, removed)
    none = hashlib.sha256(b"").hexdigest()
    pick = lambda copied, cut, rest: F.when(F.col("copied"), copied).otherwise(F.coalesce(cut, rest))
    return rows.join(found, "key", "left").select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        pick(F.lit(1), F.col("runs"), F.lit(0)).cast("bigint").alias("n_spans"),
        pick(F.lit(none), F.col("sha"), F.col("full_sha")).alias("kept_sha256"))
