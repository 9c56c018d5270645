"""Operator 11 against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from llm_cases import SF, same

from medalake.llm import conversations as C

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute_repair(rows):
    """The least (cost, edits, lines) over every sequence of edits, by extending all cheap ones: rows are (role, text,
    kind of fault)."""
    best = {(0, ""): (0, "", ())}  # (rows taken, initials) -> (cost, edits, lines)
    todo = [(0, "", "", (), 0)]
    limit = 4 * len(rows) + 6
    done = []
    seen = {}
    while todo:
        cost, audit, initials, lines, i = todo.pop()
        if cost > limit or (seen.get((i, initials, audit), limit + 1) <= cost):
            continue
        seen[i, initials, audit] = cost
        if i == len(rows) and LEGAL.match(initials):
            done.append((cost, audit, lines))
            limit = min(limit, cost)
        for role in ("user", "assistant"):
            if initials.count("u") + initials.count("a") < 2 * len(rows) + 2:
                todo.append((cost + 3, audit + "I", initials + role[0], lines + (f"{role}:",), i))
        if i < len(rows):
            role, text, kind = rows[i]
            extra = 3 * (kind == 3)
            todo.append((cost + 4, audit + "D", initials, lines, i + 1))
            if kind in (0, 3):
                todo.append((cost + extra, audit + "K", initials + (role[:1] or " "), lines + (f"{role}:{text}",), i + 1))
                for new in ("user", "assistant"):
                    todo.append((cost + extra + 3, audit + "R", initials + new[0], lines + (f"{new}:{text}",), i + 1))
    assert best
    return min(done, key=lambda d: (d[0], d[1]))


def brute(rows):
    """Expected results from all original rows (conv_id, turn, role, text), damaged first."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        own = by[conv]
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {c: brute_one(own) for c, own in by.items()}


def marked(own):
    own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, out = set(), []
    for _, role, text in own:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        kind = 1 if not last else 2 if (role, text) in seen else 0 if last[0] in ".!?" else 3
        seen.add((role, text))
        out.append((role, text, kind))
    return own, out


def brute_one(own):
    own, faults = marked(own)
    turns = {t for t, _, _ in own if t is not None}
    initials = [r[:1] or " " for _, r, _ in own]
    cost, audit, lines = brute_repair(faults)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(k == f for _, _, k in faults) for f in (1, 2, 3)],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


SCHEMA = "conv_id long, turn long, role string, text string"


def some_rows(seed=1, conversations=150, longest=5):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", None, "é.", "a\nb. \t", "x\x85", "same."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User"]
    out = []
    for c in range(conversations):
        for t in range(rnd.randrange(1, longest + 1)):
            out.append((c, t * rnd.choice((1, 1, 2)) if rnd.random() > .1 else None, rnd.choice(roles), rnd.choice(texts)))
    out += [(None, 0, "user", "hi."), (None, 1, "assistant", "ho."), (None, None, None, None), (7, 3, "user", "again."),
            (7, 3, "user", "again.")]
    return out


def test_solver_equals_all_edit_sequences():
    rnd = random.Random(4)
    names = {C.SYSTEM: "system", C.USER: "user", C.ASSISTANT: "assistant", C.OTHER: "x"}
    for _ in range(250):
        rows = [(names[rnd.choice((1, 2, 2, 3, 3, 4))], f"t{i}", rnd.choice((0, 0, 0, 1, 3))) for i in range(rnd.randrange(5))]
        symbols = bytes(3 * C._INITIAL.get(r[:1], C.OTHER) + (0, 1, 1, 2)[k] for r, _, k in rows)
        cost, audit, _ = brute_repair(rows)
        got, state = C.edits(symbols, C.after_all(), C.NONE)
        assert C.before(symbols, C.after_all())[0][C.NONE] == cost
        assert got + C.solve(b"", C.END)[state][1] == audit


def dynamic_programme(symbols):
    """Cost and least edits from each row and state on, from the end backwards, without blocks or prices."""
    tail = {C.NONE: (0, ""), C.SYSTEM: (6, "II"), C.USER: (3, "I"), C.ASSISTANT: (0, "")}
    for s in reversed(symbols):
        initial, kind = divmod(s, 3)
        own = {}
        for state in range(4):
            to = C.ASSISTANT if state == C.USER else C.USER
            ways = [(4 + tail[state][0], "D" + tail[state][1])]
            if kind != C.MUST_GO:
                extra = 3 * (kind == C.TRUNCATED)
                ways.append((3 + extra + tail[to][0], "R" + tail[to][1]))
                if initial == to or (initial == C.SYSTEM and state == C.NONE):
                    ways.append((extra + tail[initial][0], "K" + tail[initial][1]))
            own[state] = min(ways)
        for _ in range(3):  # insertions before the row
            for state in range(4):
                to = C.ASSISTANT if state == C.USER else C.USER
                own[state] = min(own[state], (3 + own[to][0], "I" + own[to][1]))
        tail = own
    return tail[C.NONE]


@pytest.mark.parametrize("n", [15, 16, 17, 100, 3000])
def test_blocks_join_into_the_least_edits(n):
    rnd = random.Random(n)
    for _ in range(8):
        symbols = bytes(rnd.choice((3, 6, 6, 6, 9, 9, 9, 12)) + rnd.choice((0, 0, 0, 1, 2)) for _ in range(n))
        audit, state = C.edits(symbols, C.after_all(), C.NONE)
        assert (C.before(symbols, C.after_all())[0][C.NONE], audit + C.solve(b"", C.END)[state][1]) == dynamic_programme(symbols)
        half = n // 2  # costs of a piece from any state to any other
        t, end = C.transfer(symbols[:half]), C.before(symbols[half:], C.after_all())[0]
        assert tuple(min(t[4 * s + x] + end[x] for x in range(4)) for s in range(4)) == C.before(symbols, C.after_all())[0]


@pytest.mark.parametrize("piece,held", [(4096, 16), (2, 1)])
def test_repair_against_brute_force(spark, monkeypatch, piece, held):
    monkeypatch.setattr(C, "PIECE", piece)
    monkeypatch.setattr(C, "PIECES_HELD", held)
    rows = some_rows()
    want = [(c, *r) for c, r in brute(rows).items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = df.selectExpr("*", "1 AS n", "2 AS first", "3 AS TEXT", "4 AS row", "5 AS sha", "6 AS part")
    for d in (df, clash):
        assert same(C.repair(spark, C.damage(d)).collect(), want)


def test_rows_and_digest_agree(spark):
    rows = some_rows(5)
    df = C.damage(spark.createDataFrame(rows, SCHEMA))
    lines = defaultdict(list)
    for r in sorted(C.repaired_rows(spark, df).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.edit in "KRI" and r.place == len(lines[r.conv_id])
    for r in C.repair(spark, df).collect():
        assert hashlib.sha256("\n".join(lines[r.conv_id]).encode()).hexdigest() == r.repaired_sha256
        assert LEGAL.match("".join(x[:1] for x in lines[r.conv_id]))


def test_one_long_conversation_over_many_partitions(spark):
    rnd = random.Random(8)
    roles, texts = ("user", "assistant", "system", "tool"), ("one.", "two", "", "three?")
    long = [(1, t, rnd.choice(roles), rnd.choice(texts) + (str(t) + "." if rnd.random() < .8 else "")) for t in range(9000)]
    long += [(1, 4, "user", "copied.")] * 3000 + [(0, 0, "user", "a."), (2, 0, "user", "a.")]
    got = {r.conv_id: r for r in C.repair(spark, spark.createDataFrame(long, SCHEMA).repartition(6)).collect()}
    own, faults = marked([r[1:] for r in long if r[0] == 1])
    symbols = bytes(3 * C._INITIAL.get(r[:1], C.OTHER) + (0, 1, 1, 2)[k] for r, _, k in faults)
    assert (got[1].cost, got[1].audit) == dynamic_programme(symbols)
    assert (got[1].gaps, got[1].duplicate) == (0, sum(k == 2 for _, _, k in faults))
    assert (got[0].cost, got[0].audit) == (got[2].cost, got[2].audit) == (3, "KI")


def test_long_texts_and_empty_tables(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "\t" * 1_000_000), (2, None, None, None)]
    got = {r.conv_id: r for r in C.repair(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].audit, got[1].cost, got[2].audit) == ("DD", 8, "D") or (got[1].cost, got[1].audit) == (7, "KDI")
    assert C.repair(spark, C.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    assert C.repaired_rows(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark):
    import __spark_entry__
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = __spark_entry__.queries()["op11_conversation_repair"](spark, SF).collect()
    assert len(got) == len({r.conv_id for r in rows}) and same([r for r in got], [(c, *r) for c, r in brute_fast(rows).items()])


def brute_fast(rows):
    """As ``brute``, with the edits of long conversations by the plain dynamic programme."""
    out = {}
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(tuple(r))
    for c, own in by.items():
        damaged = []
        for conv, turn, role, text in own:
            code = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            if code:
                text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
                damaged += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        if not damaged:
            out[c] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        ordered, faults = marked(damaged)
        symbols = bytes(3 * C._INITIAL.get(r[:1], C.OTHER) + (0, 1, 1, 2)[k] for r, _, k in faults)
        cost, audit = dynamic_programme(symbols)
        turns = {t for t, _, _ in ordered}
        initials = [r[:1] for _, r, _ in ordered]
        lines, i, state = [], 0, 0
        for e in audit:
            role, text, _ = faults[i] if e != "I" else ("", "", 0)
            i += e != "I"
            if e == "D":
                continue
            new = role if e == "K" else "assistant" if state == "u" else "user"
            state = new[:1]
            lines.append(f"{new}:{text}")
        out[c] = (max(turns) - min(turns) + 1 - len(turns), *[sum(k == f for _, _, k in faults) for f in (1, 2, 3)],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out
