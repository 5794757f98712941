"""Repair of the structure of conversations: the cheapest edits that make the roles of each one `(s?(ua)+)?`.

Turns are sorted by range partitions, so a conversation of any size lies in as many of them as it needs; what a partition
has of one is a block. Repeats are found by the first place of each role and text, combined before the shuffle. A turn
then is one letter (its role and fault), and only those letters of a conversation meet in a task, one a turn, as in the
audit, which is one value a conversation too. There the cost-to-go of every turn and grammar state is worked out
backwards, a block at a time, and a forward walk takes the ASCII-least edit among those that are tight. The texts meet
their edits by block; the blocks of a conversation that has several are hashed one after the other, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import cut

WHITE = " \t\n\x0b\x0c\r"
#: What edits cost; TRUNCATED is added to each turn that stays although it is truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Grammar states: nothing yet, after s, after u, after a. By state: where an initial leads, and the role that may be put in.
LEADS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ACCEPTED = (0, 3)
FAR = 1 << 40

#: Letters of turns: twelve from `a` on, an initial of s, u, a or another, each as sound, truncated or one that must go.
INITIALS, SOUND, CUT_OFF, GONE = "sua-", 0, 1, 2
#: Code points of a text by which turns of one place and role are ordered before its hash decides.
HEAD = 64


def closed(costs: list[int] | tuple[int, ...]) -> tuple[int, ...]:
    """costs-to-go by state once turns may be put in before."""
    u, a = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + u), min(costs[1], INSERT + u), u, a


END = closed([0 if q in ACCEPTED else FAR for q in range(4)])


def _parts(letter: str) -> tuple[str, int]:
    k = ord(letter) - 97
    return INITIALS[k // 3], k % 3


@lru_cache(maxsize=1 << 16)
def before(letter: str, after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """The costs-to-go by state before a turn from those after it, as their least and what each has over it. The
    excess is 10 at most, so few different ones occur."""
    initial, fault = _parts(letter)
    extra = TRUNCATED if fault == CUT_OFF else 0
    costs = []
    for q in range(4):
        best = DELETE + after[q]
        if fault != GONE:
            best = min(best, REROLE + extra + after[WANTED[q][1]])
            if initial in LEADS[q]:
                best = min(best, extra + after[LEADS[q][initial]])
        costs.append(best)
    costs = closed(costs)
    return min(costs), tuple(c - min(costs) for c in costs)


@lru_cache(maxsize=1 << 16)
def edits(letter: str, after: tuple[int, ...], q: int) -> tuple[str, int]:
    """The ASCII-least tight edits from state q up to the turn's own, and the state they lead to: i and j put a user and
    an assistant in, r and q make the turn one, K keeps it, D deletes it."""
    least, over = before(letter, after)
    initial, fault = _parts(letter)
    extra = TRUNCATED if fault == CUT_OFF else 0
    out = ""
    while True:
        cost = least + over[q]
        role, to = WANTED[q]
        if DELETE + after[q] == cost:
            return out + "D", q
        if INSERT + least + over[to] == cost:
            out, q = out + ("i" if role == "u" else "j"), to
            continue
        if initial in LEADS[q] and extra + after[LEADS[q][initial]] == cost:
            return out + "K", LEADS[q][initial]
        return out + ("r" if role == "u" else "q"), to


def _ends(letters: str, after: tuple[int, ...]) -> tuple[int, list[tuple[int, ...]]]:
    """What a block adds to the least cost, and the excess after each turn and, first, before them all."""
    total, steps = 0, [after]
    for letter in reversed(letters):
        least, after = before(letter, after)
        total += least
        steps.append(after)
    return total, steps[::-1]


def planned(blocks: list[str]) -> tuple[int, list[str], int]:
    """Cost, edits of each block (those of a turn end at a comma, what is put in after the last turn follows it) and
    adjacent turns that may not follow each other, of the blocks of a conversation. A block's table of costs is held at
    a time."""
    total, after, rims = 0, END, [END]
    for letters in reversed(blocks):
        more, steps = _ends(letters, after)
        total, after = total + more, steps[0]
        rims.append(after)
    cost, q, out = total + after[0], 0, []
    for letters, end in zip(blocks, reversed(rims[:-1])):
        steps, said = _ends(letters, end)[1], []
        for letter, rest in zip(letters, steps[1:]):
            piece, q = edits(letter, rest, q)
            said.append(piece + ",")
        out.append("".join(said))
    while q not in ACCEPTED:
        role, q = WANTED[q]
        out[-1] += "i" if role == "u" else "j"
    initials = "".join(blocks)
    legal = sum(_parts(x)[0] + _parts(y)[0] in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
    return cost, out, max(0, len(initials) - 1) - legal


@F.pandas_udf(T.StructType([T.StructField("cost", T.LongType()), T.StructField("edits", T.ArrayType(T.StringType())), T.StructField("illegal", T.LongType())]))
def _plan(blocks: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([planned(list(x)) for x in blocks], columns=["cost", "edits", "illegal"])


def ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text of rows, sorted within range partitions that follow each other, kept in the shared folder, with
    part (the partition) and pos (ascending along the whole). Equal rows may lie in several partitions."""
    space = F.lit(" ")
    slim = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"),
        F.monotonically_increasing_id().alias("uid"),
    ).withColumns({"head": F.left("text", F.lit(HEAD)), "hash": F.xxhash64("text")})
    keys = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "head", "hash", "uid")]
    kept = cut(slim.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("uid", "head", "hash"))
    return kept.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id())


def _letters(rows: DataFrame) -> DataFrame:
    """The blocks (conv, part) of ordered rows: letters of their turns, counts of faults, and least, greatest and number of
    different turns."""
    bare = F.rtrim("text", F.lit(WHITE))
    each = rows.select(
        "conv", "part", "pos", "turn", "role", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*".!?")).alias("truncated"),
        F.when(bare != "", F.unhex(F.sha2("text", 256))).alias("digest"),
    )
    first = each.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    known = each.drop("digest").join(first, "pos", "left")  # a row each on both sides
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = ~F.col("blank") & ~duplicate & F.col("truncated")
    fault = F.when(F.col("blank") | duplicate, GONE).when(truncated, CUT_OFF).otherwise(SOUND)
    place = F.instr(F.lit(INITIALS[:3]), F.left("role", F.lit(1))) - 1
    initial = F.when((F.col("role") == "") | (place < 0), 3).otherwise(place)
    turns = known.withColumn("letter", F.chr(97 + 3 * initial + fault)).withColumn("truncated", truncated).withColumn("duplicate", duplicate)
    return turns.groupBy("conv", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "").alias("letters"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"),
    )


def _planned(rows: DataFrame) -> DataFrame:
    """A row per conversation: counts, cost, edits by block. Turns are counted by block; two blocks share one turn at most."""
    block = F.struct("part", "letters", "low", "high", "turns")
    whole = _letters(rows).groupBy("conv").agg(F.array_sort(F.collect_list(block)).alias("xs"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    with_turns = F.filter("xs", lambda x: x["turns"] > 0)
    shared = F.aggregate(
        with_turns, F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast(rows.schema["turn"].dataType).alias("high")),
        lambda a, x: F.struct((a["n"] + x["turns"] - F.when(a["high"] == x["low"], 1).otherwise(0)).alias("n"), x["high"].alias("high")), lambda a: a["n"],
    )
    gaps = F.coalesce(F.array_max("xs.high") - F.array_min("xs.low") + 1 - shared, F.lit(0)).cast("long")
    out = whole.withColumn("gaps", gaps).withColumn("parts", F.col("xs.part")).withColumn("plan", _plan(F.col("xs.letters")))
    return cut(out.select("conv", "gaps", "blank", "duplicate", "truncated", "parts", "plan.*"))


def _said(piece: Column, role: Column, text: Column) -> Column:
    """The turns (role, text) that the edits of one turn leave."""
    turn = lambda r, t: F.struct(r.alias("role"), t.alias("text"))
    user, assistant, nothing = F.lit("user"), F.lit("assistant"), F.lit("")
    made = lambda c: F.when(c == "K", turn(role, text)).when(c == "r", turn(user, text)).when(c == "q", turn(assistant, text)).when(c == "i", turn(user, nothing)).when(c == "j", turn(assistant, nothing))
    kept = F.filter(F.split(piece, ""), lambda c: ~c.isin("D", ""))
    return F.transform(kept, made)


def _repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv, part and turns (role, text), in order, of each block after its edits. Texts move once, by block."""
    pieces = plan.select("conv", F.explode(F.arrays_zip("parts", "edits")).alias("x")).select(F.col("conv").alias("e_conv"), F.col("x.parts").alias("e_part"), F.split("x.edits", ",").alias("pieces"))
    texts = rows.groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("xs"))
    met = texts.join(pieces, F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("part") == F.col("e_part")))
    own = F.flatten(F.transform("xs", lambda x, i: _said(F.get("pieces", i), x["role"], x["text"])))
    last = _said(F.element_at("pieces", -1), F.lit(""), F.lit(""))  # what is put in after the last turn
    return met.select("conv", "part", F.concat(own, last).alias("turns"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (conv, text) in order: the hash of the non-empty texts of each conv, joined by newlines."""
    held, kept, some, kind = None, None, False, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kept], kind), pa.array([held.hexdigest()])], ["conv", "sha"])

    for b in batches:
        kind = b.schema.field("conv").type
        for conv, text in zip(b.column("conv").to_pylist(), b.column("text")):
            if held is None or conv != kept:
                if held is not None:
                    yield row()
                held, kept, some = hashlib.sha256(), conv, False
            said = text.as_py()
            if said:
                held.update((("\n" if some else "") + said).encode())
                some = True
    if held is not None:
        yield row()


def _hashes(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv and sha, the hash of its repaired turns. Conversations of one block are hashed where they are; the blocks of the
    others, fewer than there are partitions, are streamed in order, since a hash is one chain."""
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    text = _repaired(rows, plan).select("conv", "part", F.array_join(lines, "\n").alias("text"))
    many = F.broadcast(plan.where(F.size("parts") > 1).select(F.col("conv").alias("m_conv")))  # each spans a border of partitions
    same = F.col("conv").eqNullSafe(F.col("m_conv"))
    one = text.join(many, same, "left_anti").select("conv", F.sha2("text", 256).alias("sha"))
    spread = text.join(many, same, "left_semi").repartition("conv").sortWithinPartitions("conv", "part").select("conv", "text")
    return one.unionByName(spread.mapInArrow(_hashed, spread.select("conv", F.lit("").alias("sha")).schema))


def repaired_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, part, n, role, text: the turns of every conversation after its repair; part and n give their order. Odd
    rows are treated as repair does."""
    kept = ordered(rows, conv_col, turn_col, role_col, text_col)
    done = _repaired(kept, _planned(kept))
    return done.select(F.col("conv").alias(conv_col), "part", F.posexplode("turns").alias("n", "x")).select(conv_col, "part", "n", "x.role", "x.text")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit (the edits'
    initials) and repaired_sha256 (of role:text lines).

    A null role or text counts as one space; rows of a null id are one conversation. Turns are taken by turn, null ones
    first; those of one turn by role, by their first HEAD code points and then by a hash of the text. Rows that repeat are
    duplicates, and so is whatever has the role and text of a row before it. A role that is empty or begins with another
    letter than s, u and a can only be deleted or changed. Numbers of the turn may be missing; an empty table gives no
    rows; further columns are not looked at."""
    kept = ordered(rows, conv_col, turn_col, role_col, text_col)
    plan = _planned(kept)
    sha = _hashes(kept, plan).withColumnRenamed("conv", "h_conv")
    audit = F.translate(F.array_join("edits", ""), "ijrq,", "IIRR")
    return plan.join(sha, F.col("conv").eqNullSafe(F.col("h_conv"))).select(
        F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit.alias("audit"), F.col("sha").alias("repaired_sha256")
    )


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows, damaged as the remainder of a checksum of `conv_id:turn` modulo 20 says: 0
    drops a row, 1 empties its text, 2 takes .!? out, 3 repeats it and 4 makes it the user's. Nulls count as one space,
    but a null conv_id and turn stay null."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    each = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = each.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    changed = changed.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("again")).drop("again")


def audited(rows: DataFrame) -> DataFrame:
    """repair of the damaged rows, a row per conv_id of rows; one that has no rows left has zeros, an empty audit and the
    hash of nothing."""
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "f_conv")
    every = rows.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("f_conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
