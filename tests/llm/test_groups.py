"""SimHash groups, repeated strings and sharding against plain versions."""

from __future__ import annotations

import collections
import random

import brute
import pytest

from flowgrid.llm import hash_ring, simhash, suffix_buckets

SCHEMA = "doc_id long, text string, fp string, key string, size long, shard int, cell int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3) for i, t in rows], SCHEMA)


def corpus():
    base = [brute.prose(s, 150) for s in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 12]) for i in range(20)]
    rows += [(200 + i, brute.edited(base[i % 5], i, 9 + i % 40)) for i in range(25)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (305, "one two three"), (None, base[0]), (None, None),
             (306, "ß É " * 40), (307, brute.prose(77, 9000)), (100, base[0]), (100, base[0])]
    return rows


@pytest.mark.parametrize("leaf", [16384, 6])
def test_simhash_groups_equal_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rows = corpus()
    got = sorted(simhash.classes(frame(spark, rows)).collect(), key=repr)
    prints = [brute.fingerprint(t, 4, 64) for _, t in rows]
    number = brute.groups(prints, None, 4)
    least = collections.defaultdict(lambda: None)
    for (i, _), g in zip(rows, number, strict=True):
        if i is not None and (least[g] is None or i < least[g]):
            least[g] = i
    want = sorted(((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, number, strict=True)), key=repr)
    assert [tuple(r) for r in got] == [tuple(w) for w in want] or sorted(map(tuple, got), key=repr) == want
    assert simhash.classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("leaf", [16384, 8])
def test_one_of_each_near_duplicate_group_stays(spark, monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rows = [(i, t) for i, t in corpus() if i is not None and i != 100]
    kept = {r.doc_id for r in simhash.one_of_each(frame(spark, rows)).collect()}
    prints = [brute.fingerprint(t, 5, 128) for _, t in rows]
    sizes = [max(0, max(1, len((t or "").split()) - 4)) if (t or "").split() else 0 for _, t in rows]
    number = brute.groups(prints, sizes, 27, 0.75)
    want = {min(rows[j][0] for j in range(len(rows)) if number[j] == g) for g in set(number)}
    assert kept == want
    assert simhash.one_of_each(frame(spark, rows)).columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")


def test_components_of_a_long_chain(spark):
    names = [f"{i:04d}".encode() for i in range(60)]
    edges = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in zip(names, names[1:])], "a binary, b binary")
    assert {bytes(r.label) for r in simhash.components(edges).collect()} == {b"0000"}


@pytest.mark.parametrize("local", [128, 2])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, local):
    monkeypatch.setattr(suffix_buckets, "LOCAL", local)
    passage, other = brute.prose(1, 110), brute.prose(2, 90)
    texts = [None, "", "short", "a" * 1500, "ab" * 700, brute.prose(5, 300), brute.prose(5, 300), "é" * 300 + passage,
             brute.prose(6, 100) + passage + brute.prose(7, 80), passage + other, other + passage, passage[:405] + "!", "x" + passage[3:402],
             passage[5:405], passage[-400:], brute.edited(passage * 3, 4, 70), passage * 2]
    texts += [brute.prose(20 + i, 30 + i) + passage[i * 7:i * 7 + 430] + brute.prose(60 + i, 40) for i in range(14)]
    df = frame(spark, list(enumerate(texts)))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_buckets.digests(df).collect()}
    for i, want in enumerate(brute.without_repeats(texts)):
        assert got[i] == want, (i, texts[i])


def test_repeated_strings_of_nothing(spark):
    assert suffix_buckets.digests(frame(spark, [])).count() == 0
    rows = suffix_buckets.digests(frame(spark, [(None, None), (None, None), (1, "b" * 400), (1, "b" * 400)])).collect()
    assert sorted(r.n_removed for r in rows) == [0, 0, 400, 400]


def place(rows, nodes, room):
    """The walk key by key."""
    cells = collections.defaultdict(list)
    for r in rows:
        cells[r["cell"]].append(r)
    room, out, late = list(room), {}, []
    starts = [c for c, _ in nodes]
    for cell in sorted(cells):
        own = max((j for j, c in enumerate(starts) if c <= cell), default=len(nodes) - 1)
        for r in cells[cell]:
            if room[nodes[own][1]]:
                room[nodes[own][1]] -= 1
                out[r["id"]] = nodes[own][1]
            else:
                late.append((r, own))
    for r, own in late:
        while not room[nodes[own % len(nodes)][1]]:
            own += 1
        room[nodes[own % len(nodes)][1]] -= 1
        out[r["id"]] = nodes[own % len(nodes)][1]
    return out


def test_bounded_ring_equals_the_walk_key_by_key(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    placed = hash_ring.place(df).collect()
    keys = (df.select(F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("at"))
            .withColumn("cell", F.shiftrightunsigned("at", 48).cast("int")).orderBy("cell", "at", "id").collect())
    want = place([r.asDict() for r in keys], hash_ring.ring(16, 128), hash_ring.capacities(3000, 16))
    assert {r.doc_id: r.shard for r in placed} == want


def test_bounded_ring_balance_slots_and_movement(spark):
    r = random.Random(1)
    rows = [(i, brute.prose(i, r.randint(0, 9))) for i in range(1000)] + [(5, None)] * 400 + [(None, "é")] * 3
    for shards in (16, 17):
        placed = hash_ring.place(frame(spark, rows), shards).collect()
        slots = collections.defaultdict(list)
        for p in placed:
            slots[p.shard].append(p.slot)
        sizes = [len(slots[s]) for s in range(shards)]
        assert len(placed) == len(rows) and max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    keys = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    a, b = ({p.doc_id: p.shard for p in hash_ring.place(keys, n, slack=0.25).collect()} for n in (16, 17))
    assert sum(a[i] != b[i] for i in a) / 4000 < 0.3  # a plain modulus would move 16 of 17
    assert {p.size for p in hash_ring.place(frame(spark, [(1, None), (2, "é")])).collect()} == {1, 3}
    assert hash_ring.place(frame(spark, [])).count() == 0


def test_one_span_of_an_anchor_and_no_tables_left(spark, monkeypatch):
    """What an anchor's strings cover is one span, and only the result stays in the shared folder."""
    import os

    import pyarrow as pa

    passage = brute.prose(1, 110).encode()[:430]
    texts = [brute.prose(2, 60).encode()[:100] + passage + brute.prose(3, 60).encode()[:100],
             brute.prose(4, 60).encode()[:100] + passage + brute.prose(5, 60).encode()[:100]]
    cut = [t[300 - suffix_buckets.W + 1:300 + suffix_buckets.LENGTH] for t in texts]
    key = pa.array([{"a": 1, "b": 1}, {"a": 2, "b": 2}], pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    nodes = suffix_buckets._rows(key, meet=[7, 7], pos=[300, 300], lo=[0, 0], size=[suffix_buckets.W] * 2,
                                 at=[suffix_buckets.W - 1] * 2, bytes=cut)
    spans = [s for b in suffix_buckets._finish_buckets([nodes]) for s in b.to_pylist()]
    assert [(s["key"]["a"], s["start"], s["end"]) for s in spans] == [(1, 100, 530), (2, 100, 530)]

    made, plain = [], suffix_buckets.stored
    monkeypatch.setattr(suffix_buckets, "LOCAL", 2)
    monkeypatch.setattr(suffix_buckets, "stored", lambda df, name: made.append(plain(df, name)) or made[-1])
    rows = [(i, brute.prose(20 + i, 30) + brute.prose(1, 110) + brute.prose(60 + i, 40)) for i in range(6)]
    assert suffix_buckets.digests(frame(spark, rows)).where("n_removed > 0").count() == 6
    left = [t._stored_at for t in made if os.path.isdir(t._stored_at.removeprefix("file:"))]
    assert len(made) > 12 and left == [made[-1]._stored_at]
