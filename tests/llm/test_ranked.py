"""Conversation repair, graph search and dual-tree search against plain versions."""

from __future__ import annotations

import binascii
import collections
import hashlib
import math
import random
import re

import brute
import numpy as np
import pytest

from flowgrid.llm import dual_tree, pruned_graph, repair_agenda

STEP = {("B", "s"): "S", ("B", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
ROLE = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """The contract on (turn, role, text) rows of one conversation, by a table over rows and states."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, fault = set(), []
    for _, role, text in rows:
        rest = text.strip(" \t\n\x0b\x0c\r")
        fault.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(table):
        for _ in range(3):
            for q, (c, e, t) in list(table.items()):
                for i in "ua":
                    if to := STEP.get((q, i)):
                        table[to] = min(table.get(to, (9**9, "", [])), (c + 5, e + "I", [*t, ROLE[i] + ":"]))
        return table

    table = inserted({"B": (0, "", [])})
    for (_, role, text), f in zip(rows, fault, strict=True):
        new = {}
        for q, (c, e, t) in table.items():
            ways = [(q, c + 2, e + "D", t)]
            if f not in ("blank", "duplicate"):
                more = 5 * (f == "truncated")
                if to := STEP.get((q, role[:1])):
                    ways.append((to, c + more, e + "K", [*t, f"{role}:{text}"]))
                ways += [(STEP[q, i], c + 1 + more, e + "R", [*t, f"{ROLE[i]}:{text}"]) for i in "ua" if (q, i) in STEP]
            for to, *way in ways:
                new[to] = min(new.get(to, (9**9, "", [])), tuple(way))
        table = inserted(new)
    cost, audit, lines = min(table[q] for q in "BA" if q in table)
    odd = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(fault.count(k) for k in ("blank", "duplicate", "truncated")), odd, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        show = lambda v: " " if v is None else str(v)
        how = binascii.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        if how:
            out[conv] += [(turn, "user" if how == 4 else role, text)] * (1 + (how == 3))
    return out


@pytest.mark.parametrize("segment", [512, 3])
def test_conversations_are_repaired_as_the_table_says(spark, monkeypatch, segment):
    monkeypatch.setattr(repair_agenda, "SEGMENT", segment)
    r = random.Random(5)
    texts = ["One.", "Two?", "Three", "", " \t", "Four!", "é.", "x" * 5000 + ".", "  Five. \n"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), r.choice([*texts, f"Said {c} {t}.", None]))
            for c in range(60) for t in range(r.randint(1, 12))]
    rows += [(70, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for t in range(80)]  # one conversation of many pieces
    rows += [(71, 5, "user", "Again.")] * 200 + [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (72, None, None, None)]
    rows += [(73, 2, "assistant", "b."), (73, 2, "user", "a."), (73, 9, "system", "c.")]
    r.shuffle(rows)
    table = spark.createDataFrame([(*x, "a", 1) for x in rows], "conv_id long, turn long, role string, text string, audit string, part int").repartition(7)
    got = {x[0]: tuple(x)[1:] for x in repair_agenda.repaired(table).collect()}
    assert got == {c: plain_repair(x) for c, x in damage(rows).items()}
    assert max(len(x[6]) for x in got.values()) >= 190  # the audit of the 200 equal rows
    assert repair_agenda.repaired(table.limit(0)).count() == 0


def test_agenda_pops_in_order_of_cost_and_audit():
    assert repair_agenda.lightest([("system", "a.", 0)], "B", ("A", "B"), False) == {"B": (2, "D")}
    assert repair_agenda.lightest([("user", "a.", 0), ("user", "b.", 0)], "B", ("A", "B"), False) == {"A": (1, "KR")}
    assert repair_agenda.lightest([("assistant", "a.", 0)] * 2, "B", "ABSU", True)["A"] == (1, "RK")
    assert repair_agenda.lightest([("", "", 3)], "U", "ABSU", True)["A"] == (11, "DDDI")


def plain_nearest(rows, every, k):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    every_best = {}
    for i, q in rows:
        if i % every == 0:
            best = every_best.setdefault(i, {})
            for j, v in rows:
                if j != i:
                    n = min(len(q), len(v))
                    best[j] = max(best.get(j, -2), float(q[:n] @ v[:n]) / math.sqrt(q @ q) / math.sqrt(v @ v))
    return {i: sorted(best.items(), key=lambda b: (-round(b[1], 12), b[0]))[:k] for i, best in every_best.items()}


def test_graph_search_meets_recall_and_keeps_hot_vectors_whole(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * r.normal(size=16)).tolist()) for i in range(900)]
    hot = r.normal(size=16)
    rows += [(1000 + i, hot.tolist()) for i in range(450)]  # a third of the rows share a vector, others its direction
    rows += [(1500 + i, (hot * (1 + i)).tolist()) for i in range(40)]
    table = spark.createDataFrame([(i, v, 0.0) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(5)
    for some in (table, table.where("vec_id < 1500")):
        usable = pruned_graph.usable(some)
        found = pruned_graph.search(pruned_graph.index(usable, shard_rows=400), usable.where("vec_id % 50 = 0")).collect()
        got = collections.defaultdict(list)
        for x in sorted(found, key=lambda x: (x.query_id, x.rank)):
            got[x.query_id].append((x.vec_id, x.score))
        want = plain_nearest([x for x in rows if some is table or x[0] < 1500], 50, 5)
        assert got.keys() == want.keys() and all(len(b) == 5 and b == sorted(b, key=lambda x: (-x[1], x[0])) for b in got.values())
        hits = sum(s >= want[q][-1][1] - 1e-12 for q, best in got.items() for _, s in best)  # scaled copies differ in the last bit
        assert hits >= 0.9 * 5 * len(want)
    for q in range(1000, 1450, 50):  # all five are the hot vector's rows of smallest id
        assert [i for i, _ in got[q]] == [i for i in range(1000, 1006) if i != q][:5]


def test_graph_search_takes_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 0.1, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (None, [1.0, 1.0]), (6, [1e-200, 1e-200]), (7, [1e200, 0.0, 1e200]), (8, []), (9, [3.0, -0.5]), (50, [5.0])]
    table = spark.createDataFrame([(i, v, "a") for i, v in rows], "vec_id long, embedding array<double>, at string")
    got = [(x.query_id, x.rank, x.vec_id, round(x.score, 9)) for x in pruned_graph.top_k(table).collect()]
    scale = {6: [1.0, 1.0], 7: [1.0, 0.0, 1.0]}
    want = plain_nearest([(i, scale.get(i, v)) for i, v in rows], 50, 5)
    assert sorted(got) == sorted((q, n + 1, i, round(s, 9)) for q, best in want.items() for n, (i, s) in enumerate(best))
    assert pruned_graph.top_k(table.limit(0)).count() == 0 and pruned_graph.top_k(table.where("vec_id = 1")).count() == 0


def plain_ranking(docs, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = {c: c + 32 for c in range(65, 91)}
    tf = [collections.Counter(term.findall((t or "").translate(low))) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    many, length = sum(x > 0 for x in n), sum(n)
    df = collections.Counter(t for c in tf for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(term.findall((t or "").translate(low)))
    out = []
    for i, terms in asked.items():
        scores = []
        for (d, _), c, size in zip(docs, tf, n, strict=True):
            m = 10 + 90 * size * many // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if gone else d, -s) for r, (s, gone, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_dual_trees_rank_as_all_pairs_do(spark, monkeypatch):
    items = [(i, brute.prose(700 + i, 8 + i)) for i in range(30)] + [(40, None), (41, "--"), (None, "Ünïcode ha Ha"), (3, "another text es")]
    docs = [(i, brute.prose(i, 5 + i % 90)) for i in range(400)] + [(500 + i, items[i % 5][1]) for i in range(60)] + [(7, brute.prose(7, 30))] * 200
    docs += [(None, "ünïcode HA"), (None, items[2][1]), (600, None), (601, ""), (602, "..."), (603, "ÜNÏCODE x9 ha_ha"), (604, brute.prose(3, 40_000)), (605, "\x00th\x7fer")]
    want = plain_ranking(docs, items)
    table = spark.createDataFrame([(i, t, "a", 1) for i, t in docs], "doc_id long, text string, item_id string, part int").repartition(3)
    bench = spark.createDataFrame([(i, t, "b") for i, t in items], "item_id long, text string, term string")
    for pairs, rows in ((50_000, 1024), (60, 32)):  # one block of items, or several
        monkeypatch.setattr(dual_tree, "ROWS", rows)
        got = dual_tree.top_k(table, bench, pairs=pairs).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert dual_tree.top_k(table.limit(0), bench).count() == 0 and dual_tree.top_k(table, bench.limit(0)).count() == 0


def test_dual_trees_prune():
    r = np.random.default_rng(1)
    pairs = [(i, b"t%d" % t) for i in range(32) for t in range(20 * i, 20 * i + 20)]
    items = dual_tree.Items.of(pairs).weigh(np.full(640, 5), 1000, 20_000)
    search = dual_tree.Search(items, 3)
    for _ in range(4):
        rows = []
        for d in range(256):
            own = np.array([items.number[b"t%d" % t] for t in range(20 * (d // 8), 20 * (d // 8) + 20)])
            rows.append((np.sort(own), r.integers(1, 1000, 20)))
        search.block(np.arange(256), np.zeros(256, bool), rows)
    assert search.scored < 1.25 * 4 * 256 * dual_tree.ITEM_LEAF  # a document has terms of the items of one leaf; in all 32 items
