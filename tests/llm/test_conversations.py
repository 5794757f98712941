"""Conversation repair against a search over all edits and a plain rebuilding of the turns."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from regionflow.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, extra string"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
GRAMMAR = re.compile(r"(s?(ua)+)?")
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    """Rows in order and the fault of each."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return rows, faults


def plain_repair(rows):
    """Best edits by a search over (cost, audit): the first finished state is the cheapest, of those the ASCII-least."""
    rows, faults = plain_faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, said, lines = heapq.heappop(heap)
        if i == len(rows) and GRAMMAR.fullmatch(said):
            break
        state = (i, said[-1:])
        if state in done:
            continue
        done.add(state)
        options = [(5, "I", i, k, f"{name}:") for k, name in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            _, _, role, text = rows[i]
            options.append((2, "D", i + 1, "", None))
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                options += [(more, "K", i + 1, role[:1] or "-", f"{role}:{text}")] + [(1 + more, "R", i + 1, n[0], f"{n}:{text}") for n in ("user", "assistant")]
        for price, letter, j, initial, line in options:
            if initial == "" or initial in NEXT[said[-1:]]:
                heapq.heappush(heap, (cost + price, audit + letter, j, said + initial, lines + ((line,) if line is not None else ())))
    turns = [t for _, t, *_ in rows if t is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)),
    )


def columns(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def conversations(rng, n):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", "", None, "User"])
            text = rng.choice(["Hi.", "Yes!", "and then", "", " \t", None, "What?\n", "Ok.", "…", "tot. é"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None]), role, text, "x"))
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_repair_equals_a_search_over_all_edits(spark, partitions):
    rng = random.Random(5)
    rows = conversations(rng, 60)
    rows += [(99, 1, "user", "Same.", "x")] * 40 + [(99, None, "user", None, "x")] * 3  # repeats that span partitions
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "audit")
        got = {r.conv_id: columns(r) for r in C.repair(frame).collect()}
        turns = {}
        for r in sorted(C.repaired_turns(frame).collect(), key=lambda r: (r.part, r.n)):
            turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((conv, turn, " " if role is None else role, " " if text is None else text))
    assert got == {k: plain_repair(v) for k, v in by.items()}
    assert {k: sha("\n".join(v)) for k, v in turns.items()} == {k: v[-1] for k, v in got.items() if v[-1] != sha("")}


def test_a_conversation_of_many_blocks(spark):
    rng = random.Random(8)
    rows = [(1, i // 3, rng.choice(["user", "assistant", "system"]), f"{i}{rng.choice(['.', '!', '', ''])}", "") for i in range(3000)] + [(2, 0, "user", "One.", "")]
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = C.ordered(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
        assert kept.where("conv = 1").select("part").distinct().count() > 8
        got = {r.conv_id: columns(r) for r in C.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    mine = [r[:4] for r in rows if r[0] == 1]
    letters, faults = plain_faults(mine)
    code = "".join(chr(97 + 3 * "sua".index(r[2][0]) + (C.CUT_OFF if f == "truncated" else C.SOUND)) for r, f in zip(letters, faults))
    cost, pieces, illegal = C.planned([code])
    assert got[1][4:7] == (illegal, cost, pieces[0].translate(str.maketrans("ijrq", "IIRR", ",")))
    assert got[1][:4] == (0, 0, 0, faults.count("truncated"))
    assert got[2][5:7] == (2, "D")


def test_blocks_do_not_change_a_plan():
    rng = random.Random(2)
    for _ in range(300):
        letters = "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 30)))
        cuts = sorted(rng.randint(0, len(letters)) for _ in range(3))
        parts = [letters[a:b] for a, b in zip([0, *cuts], [*cuts, len(letters)])]
        cost, pieces, illegal = C.planned(parts)
        assert (cost, "".join(pieces), illegal) == (lambda x: (x[0], x[1][0], x[2]))(C.planned([letters]))


def test_query_columns(spark):
    rng = random.Random(9)
    rows = conversations(rng, 80) + [(500, t, "user", "Bye.", "") for t in range(200) if zlib.crc32(f"500:{t}".encode()) % 20 == 0]
    got = {r.conv_id: columns(r) for r in C.audited(spark.createDataFrame(rows, SCHEMA)).collect()}
    by = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        by[r[0]].append(r)
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert got == {k: plain_repair(v) if v else nothing for k, v in by.items()}
    assert got[500] == nothing
    assert C.audited(spark.createDataFrame([], SCHEMA)).count() == 0
    assert dict(C.audited(spark.createDataFrame(rows, SCHEMA)).dtypes)["cost"] == "bigint"
