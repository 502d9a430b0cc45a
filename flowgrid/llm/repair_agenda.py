"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Repair edits its rows: Keep, Rerole to
user or assistant, Delete, Insert an empty user or assistant row. Items of the deduction system are ``Row(i)`` (an
axiom) and ``At(i, state)``: the rows before i are edited so that the automaton of the pattern is in ``state``. Edits are
hyperedges - At(i, p) and Row(i) give At(i+1, q), At(i, p) alone gives At(i, q) by an insertion - whose functions add to
the cost and append to the audit, the string of the edits' initials. Both only grow, so the functions are superior:
the agenda pops items in the order of (cost, audit), each item is final when it is popped, and work ends with the goal.

A conversation may hold a third of all rows. Equal rows are counted before they are shuffled; rows are dealt by range of
(conversation, turn, row), so a long conversation spans many tasks, each of which cuts it into segments of at most
SEGMENT rows. Conversations that a task sees whole are repaired there. Of a segment at a task's edge the agenda finds
the lightest derivation between each pair of states; the segments of a conversation are then joined in order, in pairs
of equal length (two derivations meeting in a state, costs added, audits appended). The digest of the repaired rows is a
running hash, so it takes a conversation's rows in order through one task, one segment in memory at a time; only the
audit, a byte for each row, is held whole, as it is the result.

Nulls and edges: a null conv_id is a conversation of its own; null turns come first and count for no gap; null roles and
texts are one space. Rows of one turn go by their ``role:text``. Repeated rows are duplicates. Roles with another initial
than s, u or a can't be kept. A conversation without rows has zeros, no audit and the hash of nothing. Texts are read
whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgrid.llm.common import stored

# Fixed values of the contract.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
STEP = {("B", "s"): "S", ("B", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
START, GOALS, STATES = "B", ("A", "B"), "ABSU"

SEGMENT, SEGMENT_BYTES = 512, 4_000_000

Row = tuple[str, str, int]  # role, text, 0; or "", "", n for n rows in a run that must go


def faults(role: str, text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated or none."""
    rest = text.rstrip(SPACE)
    return "blank" if not rest else "duplicate" if seen else "truncated" if rest[-1] not in ".!?" else ""


def edits(row: Row, state: str) -> Iterator[tuple[str, int, str]]:
    """(next state, cost, initials) of what may be done with a row."""
    role, text, gone = row
    if gone:
        yield state, DELETE * gone, "D" * gone
        return
    yield state, DELETE, "D"
    more = TRUNCATED if text.rstrip(SPACE)[-1:] not in (".", "!", "?") else 0
    if to := STEP.get((state, role[:1])):
        yield to, KEEP + more, "K"
    for initial in ROLES:
        if initial != role[:1] and (to := STEP.get((state, initial))):
            yield to, REROLE + more, "R"


def lightest(rows: list[Row], entry: str, goals: Iterable[str], all_goals: bool) -> dict[str, tuple[int, str]]:
    """(cost, audit) of the lightest derivation of At(len(rows), g) from At(0, entry): of every state g in ``goals``, or
    of the first one alone that becomes final."""
    wanted = set(goals)
    agenda: list[tuple[int, str, int, str]] = [(0, "", 0, entry), *((0, "", i, "row") for i in range(len(rows)))]
    heapq.heapify(agenda)
    final: dict[tuple[int, str], tuple[int, str]] = {}

    def deduce(i: int, state: str) -> None:
        """The hyperedges from At(i, state) and Row(i), once both are final."""
        if (i, state) in final and (i, "row") in final:
            cost, audit = final[i, state]
            for to, more, initials in edits(rows[i], state):
                heapq.heappush(agenda, (cost + more, audit + initials, i + 1, to))

    out: dict[str, tuple[int, str]] = {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = cost, audit
        if state == "row":
            for s in STATES:
                deduce(i, s)
            continue
        if i == len(rows) and state in wanted:
            out[state] = cost, audit
            if not all_goals or len(out) == len(wanted):
                break
        deduce(i, state)
        for initial in ROLES:
            if to := STEP.get((state, initial)):
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to))
    return out


def apply(rows: Iterable[Row], audit: Iterator[str], state: str) -> Iterator[tuple[str, str]]:
    """(repaired ``role:text``, state after it) as the audit says, up to the last row's edit."""
    for role, text, gone in rows:
        for _ in range(gone or 1):
            while (edit := next(audit)) == "I":
                initial = "a" if state == "U" else "u"
                state = STEP[state, initial]
                yield f"{ROLES[initial]}:", state
            if edit == "K":
                state = STEP[state, role[:1]]
                yield f"{role}:{text}", state
            elif edit == "R":
                initial = "a" if state == "U" else "u"
                state = STEP[state, initial]
                yield f"{ROLES[initial]}:{text}", state


def ending(audit: Iterator[str], state: str) -> Iterator[str]:
    for _ in audit:
        initial = "a" if state == "U" else "u"
        state = STEP[state, initial]
        yield f"{ROLES[initial]}:"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: what the contract's damage leaves. A dropped row is one with no copies, so that
    its conversation stays known."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                                (F.crc32(key) % 20).alias("how"))
    how = F.col("how")
    return rows.select(
        "conv_id", F.when(how != 0, F.col("turn")).alias("turn"),
        F.when(how == 0, "").when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(how.isin(0, 1), "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("bigint").alias("copies"))


COUNTS = ("blank", "duplicate", "truncated", "illegal")
FACTS = (*COUNTS, "low", "high", "turns", "head", "tail", "first_turn", "last_turn", "some")
SPAN = "array<struct<a:string,b:string,cost:bigint,audit:string>>"


def _pieces_schema(kind: str) -> str:
    return (f"conv_id {kind}, part int, seq int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, turns bigint, "
            f"head string, tail string, first_turn bigint, last_turn bigint, some boolean, cost bigint, audit string, "
            f"digest string, spans {SPAN}, `rows` array<struct<role:string,text:string,gone:bigint>>")


def _facts() -> dict:
    return {**dict.fromkeys(COUNTS, 0), "low": None, "high": None, "turns": 0, "head": None, "tail": None,
            "first_turn": None, "last_turn": None, "some": False}


def _joined(a: dict, b: dict) -> dict:
    """Facts of two neighbouring pieces of a conversation."""
    if not a["some"] or not b["some"]:
        return a if a["some"] else b
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["tail"] + b["head"] not in LEGAL
    low, high = [x["low"] for x in (a, b) if x["low"] is not None], [x["high"] for x in (a, b) if x["high"] is not None]
    same = a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    return {**out, "low": min(low, default=None), "high": max(high, default=None), "turns": a["turns"] + b["turns"] - same, "head": a["head"],
            "tail": b["tail"], "first_turn": a["first_turn"], "last_turn": b["last_turn"], "some": True}


def _spans(rows: list[Row], entries: str) -> list[dict]:
    return [{"a": a, "b": b, "cost": c, "audit": t} for a in entries for b, (c, t) in lightest(rows, a, STATES, True).items()]


def _repairer(types: pa.Schema):
    """Pieces of conversations from sorted rows; whole ones come out repaired."""
    def repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list = []
        conv, begun, rows, size, seq, fact, at_edge = None, False, [], 0, 0, _facts(), True

        def close(last: bool) -> None:
            """End the current piece: repaired if the conversation lies within this task, else its spans."""
            nonlocal rows, size, seq, fact
            piece = {"conv_id": conv, "part": part, "seq": seq, **fact, "cost": None, "audit": None, "digest": None, "spans": None, "rows": None}
            if last and seq == 0 and not at_edge:
                ((cost, audit),) = lightest(rows, START, GOALS, False).values()
                rest = iter(audit)
                lines, state = [], START
                for line, state in apply(rows, rest, state):
                    lines.append(line)
                lines += ending(rest, state)
                piece |= {"cost": cost, "audit": audit, "digest": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
            else:
                piece |= {"spans": _spans(rows, START if seq == 0 and not at_edge else STATES),
                          "rows": [{"role": r, "text": t, "gone": g} for r, t, g in rows]}
            held.append(piece)
            rows, size, seq, fact = [], 0, seq + 1, _facts()

        def add(turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
            nonlocal fact, size
            fault = faults(role, text, seen)
            must = copies if fault in ("blank", "duplicate") else copies - 1
            one = {**_facts(), "low": turn, "high": turn, "turns": int(turn is not None), "head": role[:1], "tail": role[:1],
                   "first_turn": turn, "last_turn": turn, "some": True, "illegal": copies - 1}
            one["blank" if fault == "blank" else "duplicate"] += must
            one["truncated"] += fault == "truncated"
            fact = _joined(fact, one)
            if must < copies:
                rows.append((role, text, 0))
            if must:
                rows.append(("", "", must))
            size += len(text)

        def flush() -> pa.RecordBatch:
            out = pa.Table.from_pylist(held, types).combine_chunks().to_batches()[0]
            held.clear()
            return out

        for batch in batches:
            for c, turn, role, text, copies, seen in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not begun or c != conv:
                    if begun:
                        close(True)
                        at_edge = False
                    conv, begun, seq = c, True, 0
                if copies:
                    if len(rows) >= SEGMENT or size >= SEGMENT_BYTES:
                        close(False)
                    add(turn, role, text, copies, seen)
                if len(held) >= 500 or held and held[-1]["rows"]:
                    yield flush()
        if begun:
            at_edge = True  # the next task may go on with it
            close(True)
            yield flush()
    return repair


def _merge(a: dict, b: dict) -> dict:
    """Derivations of two neighbouring stretches that meet in a state; lightest first."""
    out: dict[tuple[str, str], tuple[int, str]] = {}
    for (p, m), (cost, audit) in a.items():
        for (n, q), (more, rest) in b.items():
            if m == n and ((p, q) not in out or cost + more <= out[p, q][0]):
                one = cost + more, audit + rest
                out[p, q] = min(out.get((p, q), one), one)
    return out


def _joiner(types: pa.Schema):
    """Facts, cost and audit of each conversation from its pieces, in order. Pieces are merged in pairs of equal length,
    so a character of an audit is copied as often as the number of pieces can be halved."""
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, fact, stack = None, False, _facts(), []

        def done() -> pa.RecordBatch:
            while len(stack) > 1:
                (m, b), (n, a) = stack.pop(), stack.pop()
                stack.append((n + m, _merge(a, b)))
            cost, audit = min(v for (p, q), v in stack[0][1].items() if p == START and q in GOALS)
            stack.clear()
            return pa.RecordBatch.from_pylist([{"conv_id": conv, **fact, "cost": cost, "audit": audit}], types)

        for batch in batches:
            for r in batch.to_pylist():
                if begun and r["conv_id"] != conv:
                    yield done()
                    fact = _facts()
                conv, begun = r["conv_id"], True
                fact = _joined(fact, {f: r[f] for f in FACTS})
                stack.append((1, {(s["a"], s["b"]): (s["cost"], s["audit"]) for s in r["spans"]}))
                while len(stack) > 1 and stack[-1][0] == stack[-2][0]:
                    (m, b), (n, a) = stack.pop(), stack.pop()
                    stack.append((n + m, _merge(a, b)))
        if begun:
            yield done()
    return join


def _hasher(types: pa.Schema):
    """The digest of each conversation: its audit comes first, then its pieces in order."""
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rest, state, sha, any_line = None, iter(""), START, hashlib.sha256(), False

        def put(line: str) -> None:
            nonlocal any_line
            sha.update((("\n" if any_line else "") + line).encode())
            any_line = True

        def done() -> pa.RecordBatch:
            for line in ending(rest, state):
                put(line)
            return pa.RecordBatch.from_pylist([{**head, "digest": sha.hexdigest()}], types)

        for batch in batches:
            for r in batch.to_pylist():
                if r["rows"] is None:
                    if head is not None:
                        yield done()
                    head = {k: r[k] for k in types.names if k != "digest"}
                    rest, state, sha, any_line = iter(r["audit"]), START, hashlib.sha256(), False
                    continue
                for line, state in apply([(x["role"], x["text"], x["gone"]) for x in r["rows"]], rest, state):
                    put(line)
        if head is not None:
            yield done()
    return digest


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation of
    ``conversations`` (conv_id, turn, role, text)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = dict(conversations.dtypes)["conv_id"]
    arrow = lambda ddl: to_arrow_schema(conversations.sparkSession.createDataFrame([], ddl).schema)
    rows = damaged(conversations).groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # Rows with no copies are marks of their conversation; no text is seen earlier in them.
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "text", F.col("copies") > 0).orderBy(F.asc_nulls_first("turn"))) > 1
    line = F.concat("role", F.lit(":"), "text")
    dealt = (rows.withColumn("seen", earlier).repartitionByRange("conv_id", F.asc_nulls_first("turn"), F.substring(line, 1, 64))
             .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), line).select("conv_id", "turn", "role", "text", "copies", "seen"))
    schema = _pieces_schema(kind)
    pieces = stored(dealt.mapInArrow(_repairer(arrow(schema)), schema), "conversation-pieces")
    whole, split = pieces.where(F.col("spans").isNull()), pieces.where(F.col("spans").isNotNull())
    in_order = lambda df, *by: df.repartition("conv_id").sortWithinPartitions("conv_id", *by)
    joined_schema = ", ".join(c for c in schema.split(", ") if not c.startswith(("part ", "seq ", "digest ", "spans ", "`rows` ")))
    joined = (in_order(split.drop("rows", "digest", "cost", "audit"), "part", "seq").drop("part", "seq")
              .mapInArrow(_joiner(arrow(joined_schema)), joined_schema))
    hashed_schema = joined_schema + ", digest string"
    both = joined.withColumn("part", F.lit(-1)).unionByName(split.select("conv_id", "part", "seq", "rows"), allowMissingColumns=True)
    hashed = (in_order(both, "part", "seq").drop("part", "seq").mapInArrow(_hasher(arrow(hashed_schema)), hashed_schema))
    everything = whole.select(*hashed.columns).unionByName(hashed)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("bigint"))
    return everything.select("conv_id", gaps.alias("gaps"), *COUNTS, "cost", "audit", F.col("digest").alias("repaired_sha256"))
