"""Conversation repair against an exhaustive search of edits, with its edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from test_texts import by

from bondmart.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, seg int"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = out.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64])) for c, own in out.items()}


def faults_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        last = WORD.findall(text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else
                   "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Every edit sequence that costs no more than deleting all rows."""
    best = []

    def go(i, cost, audit, kept):
        if cost > 3 * len(rows) or best and (cost, audit) > best[0][:2] and cost > best[0][0]:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] if r[:1] else "-" for r, _ in kept)):
            best[:] = [min([*best, (cost, audit, kept)])]
        for role in ("user", "assistant"):
            go(i, cost + 2, audit + "I", [*kept, (role, "")])
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", kept)
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                go(i + 1, cost + more, audit + "K", [*kept, (role, text)])
                for to in ("user", "assistant"):
                    go(i + 1, cost + 2 + more, audit + "R", [*kept, (to, text)])

    go(0, 0, "", [])
    return best[0]


def by_hand(rows, search=cheapest):
    out = []
    for conv, own in damaged(rows).items():
        faults = faults_of(own)
        cost, audit, kept = search(own, faults)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        roles = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def run(spark, rows, **given):
    df, gone = repair.damage(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    return repair.repair(df, absent=gone, **given)


def random_rows(n, longest, seed=4):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Hi.", "Yes!  ", "no end", "", " \t", None, "a?b", "Ok.\n", ".", "日本。"]
    return [(c, r.choice([t, t, t, t, None, 3]), r.choice(roles[:2] * 4 + roles), r.choice(texts[:3] * 2 + texts))
            for c in range(n) for t in range(r.randint(1, longest))]


def edge_rows():
    return [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None), (900, 1, "user", "q?"),
            (900, 1, "user", "q?"), (900, 2, "assistant", "x" * 200_000 + "."), (901, None, "user", "a."),
            (902, 10**12, "assistant", "a."), (902, 5, "user", "b."), (903, 1, "user", "a:\nb.")]


@pytest.mark.parametrize("rows,segment", [(random_rows(120, 4), 512), (random_rows(60, 4, 5), 2), (edge_rows(), 512),
                                          (edge_rows(), 1), ([], 512)], ids=["random", "cut", "edges", "edges-cut", "empty"])
def test_repair_matches_exhaustive_search(spark, monkeypatch, rows, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    got = run(spark, rows).select("conv_id", *repair.COUNTS[:1], *repair.COUNTS[1:], "audit", "repaired_sha256").collect()
    assert by(got) == by(by_hand(rows))


def by_steps(rows, faults):
    """Least (cost, audit) row by row over the grammar's states."""
    states = {0: (0, "", [])}

    def insert(now):
        for _ in range(8):
            for q, (cost, audit, kept) in list(now.items()):
                for role in ("user", "assistant"):
                    to = repair.STEP.get((q, role[0]))
                    if to is not None:
                        new = (cost + 2, audit + "I", [*kept, (role, "")])
                        if to not in now or new[:2] < now[to][:2]:
                            now[to] = new
        return now

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, kept) in insert(states).items():
            ways = [(q, cost + 3, audit + "D", kept)]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                ways += [(repair.STEP.get((q, role[:1])), cost + more, audit + "K", [*kept, (role, text)])]
                ways += [(repair.STEP.get((q, t[0])), cost + 2 + more, audit + "R", [*kept, (t, text)]) for t in ("user", "assistant")]
            for to, *way in ways:
                if to is not None and (to not in new or tuple(way[:2]) < new[to][:2]):
                    new[to] = tuple(way)
        states = new
    return min(v for q, v in insert(states).items() if q in (0, 3))


def test_long_conversations_are_split_over_tasks(spark, monkeypatch):
    r = random.Random(8)
    rows = [(7, t, r.choice(["user", "assistant", "tool"]), r.choice(["Hi.", "no", f"n{t}.", ""])) for t in range(700)]
    rows += [(8, t, "user", f"{t}.") for t in range(300)]  # a lone role: paths that stay apart
    rows += [(9, 1, "user", "same."), *[(9, 1, "user", "same.")] * 200]
    rows += [(c, t, "ua"[t % 2] + "x", f"{t}.") for c in range(10, 60) for t in range(4)]
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 40)
    got = run(spark, rows).collect()
    assert by(got) == by(by_hand(rows, by_steps))


def test_given_table_and_texts(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    given = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    want = by_hand(given, by_steps)
    assert by(repair.op12_conversation_repair(spark, SF).collect()) == by(want)
    df, gone = repair.damage(rows)
    texts = {}
    for r in sorted(repair.repair(df, texts=True, absent=gone).collect()):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(texts[r.conv_id]) - 1
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: h for c, *_, h in want if h != empty} == {
        c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()}


def test_agenda_pops_in_order_of_weight():
    seen = []

    def deduce(item, weight, chart):
        seen.append(weight)
        yield from repair.row_deductions("x0u2a1x0")(item, weight, chart)

    chart = repair.lightest([((0, ""), (0, 0))], deduce, lambda i: i == (4, 3))
    assert seen == sorted(seen) and list(chart)[-1] == (4, 3)


def test_two_audits_of_one_cost_never_begin_each_other():
    for rows in ("x0x0", "u0u2a0", "a1s0u0"):
        moves = repair.segment_moves(rows)
        assert len({(p, q) for p, q, _, _ in moves}) == len(moves)
    assert repair.repair_rows("") == (0, "") and repair.repair_rows("u0a0") == (0, "KK")


def test_absent_rows_keep_their_conversation(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")], "conv_id int, turn int, role string, text string")
    got = {r.conv_id: r for r in repair.repair(rows, absent=F.col("conv_id") == 1).collect()}
    assert got[1].audit == "" and got[1].cost == 0 and got[1].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].audit == "KI" and got[2].cost == 2
