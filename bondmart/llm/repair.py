"""Repair of damaged conversations by Knuth's lightest derivations.

A repaired conversation's role initials read ``(s?(ua)+)?``. An item ``[i, q]``
says that the first i rows are repaired and the grammar is in state q; a
deduction takes an item and the next row (or no row) to another item and adds an
edit: Keep (0), Rerole (2), Delete (3), Insert (2), and 1 for a truncated row
that stays. An item's weight is (cost, audit), the audit being the edits'
initials. Every deduction is monotone and superior (it never gives less than its
premise), so the agenda pops items by weight, the first pop of an item is its
lightest derivation, and it stops when the goal finalises.

Rows are dealt by ranges of (conversation, turn, ...), so a conversation of any
length is split over tasks. One that lies inside a task's range is repaired
there; others are cut into segments of bounded size. A segment gives the
lightest derivation between every two grammar states; these are items of a
second agenda whose binary deductions join a derived prefix with the next
segment. (Of two audits of one segment and one cost none begins the other, so
joining keeps their order.) The repaired text of such a conversation is then
hashed as a stream in row order, which its one digest asks for; no task holds
its texts.

Defined cases: rows go by turn, nulls first, ties by role, then text; null role
or text reads as one space; rows that are equal in all columns are copies, the
first of them stays; a null conv_id is a conversation of its own; a conversation
without rows has zeros, an empty audit and the empty string's hash; texts of any
length; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondmart.llm.common import column, materialize, ship, table

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED_STAYS = 1
SOUND, GONE, TRUNCATED = "0", "1", "2"  # a row that may stay, must go, or stays at a price
SEGMENT_ROWS, SEGMENT_BYTES = 512, 4 << 20
NAMES = {"u": "user", "a": "assistant"}

#: grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ACCEPTING = (0, 1, 2, 3), (0, 3)
LEGAL = {"su", "ua", "au"}

Weight = tuple[int, str]


# ------------------------------------------------------------------ agenda

def lightest(axioms: Iterable[tuple[Weight, Hashable]], deduce: Callable, goals: Callable[[Hashable], bool] = lambda item: False,
             ) -> dict[Hashable, Weight]:
    """Knuth's agenda: the lightest weight of every item that is finalised,
    in the order of finalising; it ends with the first goal.

    ``deduce(item, weight, chart)`` gives the (weight, item) that follow from
    ``item`` and, as other premises, items of the chart."""
    agenda, chart = [*axioms], {}
    heapq.heapify(agenda)
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in chart:
            continue
        chart[item] = weight
        if goals(item):
            break
        for light, to in deduce(item, weight, chart):
            if to not in chart:
                heapq.heappush(agenda, (light, to))
    return chart


def row_deductions(rows: str) -> Callable:
    """Deductions over ``rows``: two characters a row, its role's initial (x if
    not s, u or a) and its fault."""
    n = len(rows) // 2

    def deduce(item, weight, chart):
        i, q = item
        cost, audit = weight
        for role in "ua":
            if (q, role) in STEP:
                yield (cost + INSERT, audit + "I"), (i, STEP[q, role])
        if i == n:
            return
        initial, fault = rows[2 * i], rows[2 * i + 1]
        yield (cost + DELETE, audit + "D"), (i + 1, q)
        if fault != GONE:
            stays = TRUNCATED_STAYS if fault == TRUNCATED else 0
            if (q, initial) in STEP:
                yield (cost + KEEP + stays, audit + "K"), (i + 1, STEP[q, initial])
            for role in "ua":
                if (q, role) in STEP:
                    yield (cost + REROLE + stays, audit + "R"), (i + 1, STEP[q, role])

    return deduce


@functools.lru_cache(1 << 16)
def repair_rows(rows: str) -> Weight:
    """Cost and audit of a whole conversation."""
    n = len(rows) // 2
    chart = lightest([((0, ""), (0, 0))], row_deductions(rows), lambda item: item[0] == n and item[1] in ACCEPTING)
    return next(reversed(chart.values()))


def segment_moves(rows: str) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, audit) of a segment's lightest derivations."""
    n, out = len(rows) // 2, []
    for p in STATES:
        left = set(STATES)

        def done(item):
            if item[0] == n:
                left.discard(item[1])
            return not left

        chart = lightest([((0, ""), (0, p))], row_deductions(rows), done)
        out += [(p, q, *chart[n, q]) for q in STATES if (n, q) in chart]
    return out


def join_segments(moves: list[list[tuple[int, int, int, str]]]) -> Weight:
    """Cost and audit of a conversation from its segments' derivations: prefix
    items (k, q) join the segment items of the next place."""
    n = len(moves)
    out = [{p: [m for m in own if m[0] == p] for p in STATES} for own in moves]

    def deduce(item, weight, chart):
        k, q = item
        if k < n:
            for _, r, cost, audit in out[k][q]:
                yield (weight[0] + cost, weight[1] + audit), (k + 1, r)

    chart = lightest([((0, ""), (0, 0))], deduce, lambda item: item[0] == n and item[1] in ACCEPTING)
    return next(reversed(chart.values()))


class Repaired:
    """Applies an audit to rows in order; takes each repaired row to ``put``."""

    def __init__(self, put: Callable[[str, str], None]):
        self.put, self.state, self.letters = put, 0, iter("")

    def audit(self, letters: str) -> None:
        """The edits of the rows to come; what is left of the last ones are inserts."""
        self.flush()
        self.letters = iter(letters)

    def _next_role(self) -> str:
        return "a" if self.state == 2 else "u"

    def _insert(self) -> None:
        role = self._next_role()
        self.put(NAMES[role], "")
        self.state = STEP[self.state, role]

    def row(self, role: str, text: str) -> None:
        while (edit := next(self.letters)) == "I":
            self._insert()
        if edit != "D":
            initial = role[:1] if edit == "K" else self._next_role()
            self.put(role if edit == "K" else NAMES[initial], text)
            self.state = STEP[self.state, initial]

    def flush(self) -> None:
        for _ in self.letters:
            self._insert()


class Digest:
    """SHA-256 of ``role:text`` rows joined by line feeds."""

    def __init__(self):
        self.hash, self.n = hashlib.sha256(), 0

    def put(self, role: str, text: str) -> None:
        self.hash.update((f"\n{role}:{text}" if self.n else f"{role}:{text}").encode())
        self.n += 1


# ------------------------------------------------------------------- Spark

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
MOVES = "array<struct<p:int,q:int,cost:long,audit:string>>"
RECORD = (f"kind string, part int, seg long, pos long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, "
          f"repaired_sha256 string, role string, text string, n long, first string, last string, turn_min long, "
          f"turn_first long, turn_max long, turns long, moves {MOVES}")
PLAN = f"part int, seg long, pos long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, letters string, role string, text string"
DIGEST = f"{', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
TEXTS = "place long, role string, text string"


def schema(conv: T.DataType, columns: str) -> T.StructType:
    """``conv_id`` of the given type, then ``columns``."""
    return T.StructType([T.StructField("conv_id", conv), *T._parse_datatype_string(columns).fields])


def records(rows: list[dict], to: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, to)


class Facts:
    """What the rows of a segment add up to."""

    def __init__(self):
        self.roles: list[str] = []
        self.signature: list[str] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.turns: set[int] = set()

    def add(self, turn: int | None, role: str, fault: str) -> None:
        self.roles.append(role[:1])
        if fault:
            self.faults[fault] += 1
        own = {"": SOUND, "truncated": TRUNCATED}.get(fault, GONE)
        self.signature.append((role[:1] if role[:1] in ("s", "u", "a") else "x") + own)
        if turn is not None:
            self.turns.add(turn)

    def illegal(self) -> int:
        return sum(a + b not in LEGAL for a, b in zip(self.roles, self.roles[1:]))

    def gaps(self) -> int:
        return max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0


def _first_pass(to: pa.Schema, part: Callable[[], int], texts: bool):
    """Rows sorted by conversation and place -> a 'done' record for each
    conversation inside the task's range ('out' records with ``texts``); for
    the first and last and for long ones 'segment' and 'row' records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_part, out = part(), []
        conv, begun, held, facts, size, seg, number = None, False, [], Facts(), 0, 0, 0

        def close_segment():
            nonlocal held, facts, size, seg
            out.extend({"conv_id": conv, "kind": "row", "part": own_part, "seg": seg, "pos": i, "role": r, "text": t}
                       for i, (r, t) in enumerate(held))
            moves = [dict(zip(("p", "q", "cost", "audit"), m)) for m in segment_moves("".join(facts.signature))]
            out.append({"conv_id": conv, "kind": "segment", "part": own_part, "seg": seg, "pos": -1, **facts.faults,
                        "illegal": facts.illegal(), "n": len(held), "first": facts.roles[0] if held else None,
                        "last": facts.roles[-1] if held else None, "turn_min": min(facts.turns, default=None),
                        "turn_max": max(facts.turns, default=None), "turns": len(facts.turns), "moves": moves})
            held, facts, size, seg = [], Facts(), 0, seg + 1

        def close(last: bool):
            nonlocal held, facts, size, seg, number
            if number == 0 or last or seg:
                close_segment()
            else:
                cost, audit = repair_rows("".join(facts.signature))
                digest, rows = Digest(), []
                put = Repaired((lambda r, t: rows.append((r, t))) if texts else digest.put)
                put.audit(audit)
                for role, text in held:
                    put.row(role, text)
                put.flush()
                if texts:
                    out.extend({"conv_id": conv, "kind": "out", "pos": i, "role": r, "text": t} for i, (r, t) in enumerate(rows))
                else:
                    out.append({"conv_id": conv, "kind": "done", "gaps": facts.gaps(), **facts.faults, "illegal": facts.illegal(),
                                "cost": cost, "audit": audit, "repaired_sha256": digest.hash.hexdigest()})
            held, facts, size, seg, number = [], Facts(), 0, 0, number + 1

        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "absent"))):
                if not begun or row[0] != conv:
                    if begun:
                        close(False)
                    conv, begun = row[0], True
                if row[5]:
                    continue
                if len(held) >= SEGMENT_ROWS or size >= SEGMENT_BYTES:
                    close_segment()
                held.append((row[2], row[3]))
                facts.add(row[1], row[2], row[4])
                size += len(row[3])
                if len(out) >= 2000:
                    yield records(out, to)
                    out.clear()
        if begun:
            close(True)
        yield records(out, to)

    return run


def _combine(to: pa.Schema):
    """Segments of one conversation -> its result, and each segment's share of the audit."""

    def run(segments: pa.Table) -> pa.Table:
        own = sorted(segments.to_pylist(), key=lambda s: (s["part"], s["seg"]))
        cost, audit = join_segments([[(m["p"], m["q"], m["cost"], m["audit"]) for m in s["moves"]] for s in own])
        total = {f: sum(s[f] for s in own) for f in ("blank", "duplicate", "truncated", "illegal")}
        filled = [s for s in own if s["n"]]
        total["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(filled, filled[1:]))
        dated = [s for s in own if s["turns"]]
        turns = sum(s["turns"] for s in dated) - sum(a["turn_max"] == b["turn_min"] for a, b in zip(dated, dated[1:]))
        gaps = dated[-1]["turn_max"] - dated[0]["turn_min"] + 1 - turns if dated else 0
        out, at = [], 0
        for k, s in enumerate(own):
            start, rows = at, 0
            while rows < s["n"]:
                rows += audit[at] != "I"
                at += 1
            if k == len(own) - 1:
                at = len(audit)
            out.append({"conv_id": s["conv_id"], "part": s["part"], "seg": s["seg"], "pos": -1, "letters": audit[start:at]})
        out[0].update(total, gaps=gaps, cost=cost, audit=audit)
        return pa.Table.from_pylist(out, to)

    return run


def _second_pass(to: pa.Schema, texts: bool):
    """Segment shares and rows in order -> the result of each split
    conversation, its text hashed (or given out) as it streams by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, result, digest, repaired, conv, place = [], None, None, None, None, 0

        def put(role, text):
            nonlocal place
            if texts:
                out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                place += 1
            else:
                digest.put(role, text)

        def close():
            repaired.flush()
            if not texts:
                out.append({"conv_id": conv, **result, "repaired_sha256": digest.hash.hexdigest()})

        for batch in batches:
            for row in batch.to_pylist():
                if row["pos"] < 0:
                    if row["cost"] is not None:  # the first of a conversation
                        if repaired:
                            close()
                        conv, place, digest, repaired = row["conv_id"], 0, Digest(), Repaired(put)
                        result = {c: row[c] for c in (*COUNTS, "audit")}
                    repaired.audit(row["letters"])
                else:
                    repaired.row(row["role"], row["text"])
                if len(out) >= 2000:
                    yield records(out, to)
                    out.clear()
        if repaired:
            close()
        yield records(out, to)

    return run


def _task() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()


def arrow(s: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(s)


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` stored once with a row number, and each row's first fault. A
    row is a duplicate if it isn't the first of its role and text in the
    conversation; the firsts come from one grouped minimum and are joined back
    on the row number, so a text that fills a conversation is no hot key."""
    word, last = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
    stored = materialize(rows.withColumns({
        "row_id": F.monotonically_increasing_id(),
        "content": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
        "own": F.when(~F.col("text").rlike(word), "blank").when(~F.col("text").rlike(last), "truncated").otherwise(""),
    }), "rows")
    firsts = stored.where("not absent and own <> 'blank'").groupBy("conv_id", "content").agg(
        F.min(F.struct("turn", "row_id")).alias("least")).select(F.col("least.row_id").alias("row_id"), F.lit(True).alias("is_first"))
    repeated = F.col("is_first").isNull() & (F.col("own") != "blank")
    return stored.join(firsts, "row_id", "left").withColumn("fault", F.when(repeated, "duplicate").otherwise(F.col("own")))


def repair(rows: DataFrame, texts: bool = False, absent: Column | None = None) -> DataFrame:
    """Repair conversations of rows (conv_id, turn, role, text).

    One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256; with ``texts`` the repaired rows
    instead: conv_id, place, role, text. ``absent``: rows that are not there
    any more, but whose conversation is."""
    ship(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[
        F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.coalesce(F.lit(False) if absent is None else absent, F.lit(False)).alias("absent"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64), "content", "row_id"]
    dealt = with_faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    first = schema(conv, RECORD)
    found = materialize(dealt.select("conv_id", "turn", "role", "text", "fault", "absent").mapInArrow(
        _first_pass(arrow(first), _task, texts), first), "repaired")
    plan = schema(conv, PLAN)
    shares = found.where("kind = 'segment'").groupBy("conv_id").applyInArrow(_combine(arrow(plan)), plan)
    lines = found.where("kind = 'row'").select("conv_id", "part", "seg", "pos", "role", "text")
    stream = shares.unionByName(lines, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "seg", "pos")
    out = schema(conv, TEXTS if texts else DIGEST)
    split = stream.mapInArrow(_second_pass(arrow(out), texts), out)
    if texts:
        whole = found.where("kind = 'out'").select("conv_id", F.col("pos").alias("place"), "role", "text")
    else:
        whole = found.where("kind = 'done'").select(*out.names)
    return whole.unionByName(split)


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Damaged rows of (conv_id, turn, role, text) by crc32(conv_id:turn) % 20,
    and which of them are dropped: 0 drops a row, 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 makes it the user's."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    rows = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"), "kind",
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows, F.col("kind") == 0


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = damage(table(spark, sf_dir, "conversations"))
    return repair(rows, absent=dropped)
