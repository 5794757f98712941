import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators import active, assembly, haplotypes, pairhmm


def text_of(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def reference(spark, texts, width=60):
    rows = [(i, f"c{i}", k // width, width, t[k : k + width]) for i, t in enumerate(texts) for k in range(0, len(t), width)]
    return spark.createDataFrame(rows, "contig_id int, contig string, line long, width int, seq string")


def plain_likelihood(read, qual, hap):
    """The three-state recursion, cell by cell, scaled by row in Python floats."""
    opened, longer = 10 ** (-pairhmm.GAP_OPEN / 10), 10 ** (-pairhmm.GAP_EXTEND / 10)
    m, x = [0.0] * (len(hap) + 1), [0.0] * (len(hap) + 1)
    y, scale = [1 / len(hap)] * (len(hap) + 1), 0.0
    for base, q in zip(read, qual):
        e = 10 ** (-max(ord(q) - 33, pairhmm.LEAST) / 10)
        nm, nx, ny = ([0.0] * (len(hap) + 1) for _ in range(3))
        for j in range(1, len(hap) + 1):
            prior = 1 - e if base == hap[j - 1] or "N" in (base, hap[j - 1]) else e / 3
            nm[j] = prior * ((1 - 2 * opened) * m[j - 1] + (1 - longer) * (x[j - 1] + y[j - 1]))
            nx[j] = opened * m[j] + longer * x[j]
            ny[j] = opened * nm[j - 1] + longer * ny[j - 1]
        top = max(map(max, (nm, nx, ny)))
        m, x, y = ([v / top for v in r] for r in (nm, nx, ny))
        scale += math.log10(top)
    return math.log10(sum(m) + sum(x)) + scale


def test_pair_likelihoods_equal_a_plain_recursion():
    rng = random.Random(1)
    cases = []
    for k in range(120):
        hap = text_of(rng, rng.randint(1, 90))
        a = rng.randrange(len(hap))
        read = list(hap[a : a + rng.randint(1, 70)])
        for _ in range(rng.choice([0, 0, 1, 3])):
            p = rng.randrange(len(read) + 1)
            read[p : p + rng.randint(0, 2)] = rng.choices("ACGTN", k=rng.randint(0, 3))
        read = "".join(read) or "A"
        cases.append((read, "".join(chr(33 + rng.choice([2, 12, 30, 40])) for _ in read), hap if k % 9 else hap + "N" * 3))
    cases.append((text_of(rng, 700), "I" * 700, text_of(rng, 500)))  # so unlikely that numbers vanish
    got = pairhmm.likelihoods(*map(list, zip(*cases)))
    for (read, qual, hap), value in zip(cases, got):
        assert value == pytest.approx(plain_likelihood(read, qual, hap), abs=1e-6)
    assert got[-1] < pairhmm.FAINT
    assert list(pairhmm.likelihoods(["", "A"], ["", "I"], ["ACGT", ""])) == [0.0, -math.inf]


def edges_of(texts, k):
    out = {}
    for t, n in texts:
        for i in range(len(t) - k):
            out[t[i : i + k + 1]] = out.get(t[i : i + k + 1], 0) + n
    return out


def plain_ways(ref, edges, k):
    """Every way from the first word to the last that has no word twice."""
    after = {}
    for w in [*edges, *(ref[i : i + k + 1] for i in range(len(ref) - k))]:
        after.setdefault(w[:k], set()).add(w[k])
    out, todo = set(), [ref[:k]]
    while todo:
        t = todo.pop()
        if t[-k:] == ref[-k:]:
            out.add(t)
            continue
        seen = {t[i : i + k] for i in range(len(t) - k + 1)}
        todo += [t + b for b in after.get(t[-k:], ()) if t[-k + 1 :] + b not in seen]
    return out


def test_haplotypes_are_all_ways_through_the_graph():
    rng, usable = random.Random(2), 0
    for _ in range(60):
        ref = text_of(rng, 60)
        texts = [(ref, 9)]
        for _ in range(rng.randint(0, 3)):
            p, x = rng.randint(10, 38), rng.random()
            t = ref[:p] + (text_of(rng, 12) + ref[p:] if x < 0.4 else ref[p + 12 :] if x < 0.7 else rng.choice("ACGT") + ref[p + 1 :])
            texts.append((t, rng.randint(1, 9)))
        edges = edges_of(texts, 8)
        try:
            got = assembly.haplotypes(ref, edges, 8, most=10**6)
        except assembly.Unusable:
            with_cycle = assembly.haplotypes(ref, edges, 8, last=True, most=10**6)
            assert with_cycle == [ref] or set(with_cycle) == plain_ways(ref, edges, 8)
            continue
        usable += 1
        assert got[0] == ref and len(got) == len(set(got)) and set(got) == plain_ways(ref, edges, 8)
        assert {t for t, _ in texts} <= set(got)
    assert usable > 30


def test_cycles_ask_for_longer_words():
    ref = "ACGTTGCA" + "GATTACA" * 3 + "TTGGCCAA"
    with pytest.raises(assembly.Unusable):
        assembly.haplotypes(ref, {}, 5)
    longer = ref.replace("GATTACA" * 3, "GATTACA" * 4)
    assert assembly.haplotypes(ref, edges_of([(longer, 5)], 24), 24)[0] == ref
    assert assembly.haplotypes("ACGT", {}, 9) == ["ACGT"]


def test_differences_rebuild_the_haplotype_and_stand_leftmost():
    rng = random.Random(3)
    for _ in range(400):
        ref = text_of(rng, 40) if rng.random() < 0.6 else "".join(rng.choices("AC", k=40))
        hap = list(ref)
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(1, len(hap) - 5)
            hap[p : p + rng.randint(0, 5)] = rng.choices("ACGT", k=rng.randint(0, 4))
        hap = "".join(hap)
        events = assembly.aligned(hap, ref)
        built = ref
        for at, old, new in reversed(events):
            assert ref[at : at + len(old)] == old and old != new
            built = built[:at] + new + built[at + len(old) :]
        assert built == hap
        for at, old, new in events:
            whole = ref[:at] + new + ref[at + len(old) :]
            b, o, n = assembly.normalised(ref, at, old, new)
            assert ref[b : b + len(o)] == o and ref[:b] + n + ref[b + len(o) :] == whole
            if len(o) != len(n) and b and min(len(o), len(n)) == 1 and o[0] == n[0]:  # no way to stand one further left
                assert not any(ref[:a] + m + ref[a + len(o) :] == whole for a in range(b) for m in [ref[a] + n[1:] if len(n) > 1 else ref[a]])


def test_sites_of_several_alleles():
    ref = "ACGTACGGTTCAAGCTAGGA"
    haps = [ref, ref[:8] + "C" + ref[9:], ref[:8] + ref[11:], ref[:8] + "C" + ref[9:14] + "GGG" + ref[14:]]
    assert assembly.sites(haps, ref) == [(7, "GTTC", ["G"], [0, 0, 1, 0]), (8, "T", ["C", "*"], [0, 1, 2, 1]), (12, "A", ["AGGG"], [0, 0, 0, 1])]


def plain_regions(rows, reach, threshold, gap, longest):
    out = []
    for c in {r[0] for r in rows}:
        own = {p: a for k, p, a in rows if k == c}
        on = sorted(p for p in own if sum(a for q, a in own.items() if abs(p - q) <= reach) >= threshold)
        runs = []
        for p in on:
            if runs and p - runs[-1][1] <= gap:
                runs[-1][1] = p
            else:
                runs.append([p, p])
        for lo, hi in runs:
            n = hi - lo + 1
            k = -(-n // longest)
            out += [(c, lo + n * i // k, lo + n * (i + 1) // k - 1) for i in range(k)]
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_regions_do_not_depend_on_partitions(spark, monkeypatch, partitions):
    monkeypatch.setattr(active, "BIN", 64)
    rng = random.Random(5)
    rows = [(c, p, rng.choice([0, 0, 20, 50, 90])) for c in (0, 1, 2) for p in sorted(rng.sample(range(1, 3000), 500))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(rows + [(None, 5, 999), (1, None, 999)], "contig_id int, pos long, activity long").repartition(partitions)
        got = sorted((r.contig_id, r.lo, r.hi) for r in active.regions(frame, 6, 100, 9, 40).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == plain_regions(rows, 6, 100, 9, 40) and len(got) > 50


def made_read(rng, text, at, cigar):
    """Bases of a read at at (from 0) with a CIGAR; what is put in or clipped is random."""
    out, p = "", at
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", cigar)):
        out += text[p : p + n] if op == "M" else text_of(rng, n) if op in "IS" else ""
        p += n if op in "MD" else 0
    return out, p


def test_evidence_and_depth_equal_a_walk_over_the_bases(spark, monkeypatch):
    monkeypatch.setattr(active, "BIN", 50)
    rng = random.Random(6)
    text = text_of(rng, 400)
    rows, n, depth = [], {}, {}
    for k in range(120):
        at, cigar = rng.randint(0, 330), rng.choice(["40M", "5S35M", "20M3I17M", "10M4D30M", "30M10S", "3S10M2D10M1I16M"])
        seq, stop = made_read(rng, text, at, cigar)
        seq = "".join(rng.choice("ACGTN") if rng.random() < 0.05 else x for x in seq)
        qual = "".join(chr(33 + rng.choice([5, 9, 10, 35])) for _ in seq)
        rows.append((f"r{k}", 0, at + 1, 0, 60, cigar, seq, qual, text[at:stop]))
        places, p, q = set(), at, 0
        for i, (size, op) in enumerate((int(x), op) for x, op in re.findall(r"(\d+)([MIDS])", cigar)):
            if op == "M":
                places |= {p + j for j in range(size) if seq[q + j] != text[p + j] and seq[q + j] != "N" and ord(qual[q + j]) - 33 >= 10}
            else:
                places.add(p if op == "S" and i == 0 else p - 1)
            p, q = p + size * (op in "MD"), q + size * (op in "MIS")
        for x in places:
            n[x + 1] = n.get(x + 1, 0) + 1
        for x in range(at + 1, stop + 1):
            depth[x] = depth.get(x, 0) + 1
    frame = spark.createDataFrame(rows, "rec_id string, contig_id int, pos long, flag int, mapq int, cigar string, seq string, qual string, window string")
    found = active.evidence(frame)
    assert {r.pos: r.n for r in found.collect()} == n
    spans = frame.select("contig_id", F.col("pos").alias("lo"), haplotypes.end_of(F.col("cigar")).alias("hi"))
    assert {r.pos: (r.n, r.depth) for r in active.depths(spans, found).collect()} == {p: (k, depth.get(p, 0)) for p, k in n.items()}
    whole = haplotypes.activity(frame.drop("window"), reference(spark, [text]))
    assert {r.pos: r.activity for r in whole.collect()} == {p: min(1000, 1000 * k // max(1, depth.get(p, 0))) for p, k in n.items() if k >= 2}


def test_pieces_are_what_stands_over_a_region(spark):
    rng = random.Random(7)
    text = text_of(rng, 300)
    rows, want = [], {}
    for k in range(60):
        at, cigar = rng.randint(0, 220), rng.choice(["60M", "5S55M", "30M3I27M", "20M6D40M", "50M10S"])
        seq, stop = made_read(rng, text, at, cigar)
        rows.append((f"r{k}", 0, at + 1, 0, 60, cigar, seq, "I" * len(seq)))
        lo, hi, p, q, a, b = 99, 179, at, 0, None, 0  # the region 110-170 with 10 beside it, from 0
        for size, op in ((int(x), op) for x, op in re.findall(r"(\d+)([MIDS])", cigar)):
            for _ in range(size):
                if op == "M" and lo <= p <= hi:
                    a, b = q if a is None else a, q + 1
                p, q = p + (op in "MD"), q + (op in "MIS")
        if a is not None:
            a, b = 0 if at >= lo else a, len(seq) if stop - 1 <= hi else b
            if b - a >= haplotypes.LEAST_BASES:
                want[f"r{k}"] = seq[a:b]
    frame = spark.createDataFrame(rows, "rec_id string, contig_id int, pos long, flag int, mapq int, cigar string, seq string, qual string")
    region = spark.createDataFrame([(7, 0, 110, 170)], "region long, contig_id int, lo long, hi long")
    got = {r.rec_id: r.seq for r in haplotypes.pieces(frame, region, 10).collect()}
    assert got.keys() == want.keys()
    for k in got:  # an insertion or deletion at the border may belong to either side
        assert got[k] == want[k] or got[k].startswith(want[k]) or want[k].startswith(got[k]) or got[k].endswith(want[k]) or want[k].endswith(got[k])


def sampled(rng, texts, copies, n, length=100):
    """Reads of two copies of each text; a copy is (bases, places): where each base stands in the text, None for one put in."""
    rows = []
    for k in range(n):
        c = k % len(texts)
        bases, places = copies[c][k // len(texts) % 2]
        at = rng.randrange(len(bases) - length)
        part, own = bases[at : at + length], places[at : at + length]
        ops = ""
        for i, p in enumerate(own):
            last = next((x for x in reversed(own[:i]) if x is not None), None)
            ops += "D" * (p - last - 1 if p is not None and last is not None else 0) + ("M" if p is not None else "I")
        lead = len(ops) - len(ops.lstrip("I"))
        tail = len(ops) - len(ops.rstrip("I"))
        ops = "S" * lead + ops[lead : len(ops) - tail] + "S" * tail
        cigar = "".join(f"{len(m[0])}{m[0][0]}" for m in re.finditer(r"(.)\1*", ops))
        qual = ["I"] * length
        if k % 3 == 0:
            e = rng.randrange(length)
            part, qual[e] = part[:e] + rng.choice("ACGT") + part[e + 1 :], "&"
        rows.append((f"r{k}", c, next(p for p in own if p is not None) + 1, 0, 60 if k % 50 else None, cigar, part, "".join(qual)))
    return rows


def edited(text, edits):
    """text with edits (place, bases left out, bases put in) and the place of each base."""
    out, places, p = "", [], 0
    for at, gone, new in sorted(edits):
        out, places = out + text[p:at], places + list(range(p, at))
        out, places = out + new, places + ([at] if gone == len(new) == 1 else [None] * len(new))
        p = at + gone
    return out + text[p:], places + list(range(p, len(text)))


def test_planted_variants_are_called(spark):
    rng = random.Random(8)
    texts = [text_of(rng, 1500) for _ in range(2)]
    texts[1] = texts[1][:700] + "CA" * 9 + texts[1][700:]
    copies, want = [], set()
    for c, text in enumerate(texts):
        other = lambda p: "ACGT"["ACGT".index(text[p]) - 1]  # noqa: B023, E731
        third = lambda p: "ACGT"["ACGT".index(text[p]) - 2]  # noqa: B023, E731
        put = text_of(rng, 11) + other(300)
        kept = next(p for p in range(500, 540) if text[p + 12] != text[p])
        one = [(150, 1, other(150)), (300, 0, put), (1000, 1, other(1000)), (1300, 1, other(1300))]
        two = [(150, 1, other(150)), (kept + 1, 12, ""), (1000, 1, third(1000)), (1303, 1, other(1303))]
        if c:
            two.append((700, 4, ""))  # two repeats fewer
            want.add((1, 700, text[699:704], (text[699],), "0/1"))
        copies.append([edited(text, one), edited(text, two)])
        put_at, put_new = 300, put
        while put_new[-1] == text[put_at - 1]:
            put_at, put_new = put_at - 1, text[put_at - 1] + put_new[:-1]
        want |= {
            (c, 151, text[150], (other(150),), "1/1"), (c, put_at, text[put_at - 1], (text[put_at - 1] + put_new,), "0/1"), (c, kept + 1, text[kept : kept + 13], (text[kept],), "0/1"),
            (c, 1001, text[1000], tuple(sorted((other(1000), third(1000)))), "1/2"), (c, 1301, text[1300], (other(1300),), "0/1"), (c, 1304, text[1303], (other(1303),), "0/1"),
        }
    rows = sampled(rng, texts, copies, 1600)
    frame = spark.createDataFrame(rows, "rec_id string, contig_id int, pos long, flag int, mapq int, cigar string, seq string, qual string")
    low = frame.limit(200).withColumn("mapq", F.lit(3)).withColumn("seq", F.reverse("seq")).withColumn("rec_id", F.concat(F.lit("x"), "rec_id"))  # count nowhere
    calls = haplotypes.call(frame.unionByName(low), reference(spark, texts)).collect()
    assert {(r.contig_id, r.pos, r.ref, tuple(sorted(r.alts)), r.gt) for r in calls} == want
    for r in calls:
        n = len(r.alts) + 1
        i, j = map(int, r.gt.split("/"))
        assert len(r.ad) == n and len(r.pl) == n * (n + 1) // 2 and r.pl[j * (j + 1) // 2 + i] == 0 and r.gq > 20 and sum(r.ad) <= r.dp
    assert haplotypes.call(frame.where("mapq < 0"), reference(spark, texts)).count() == 0
    assert R.REVERSE == 16


def test_few_bytes_of_much_work_are_many_tasks(spark):
    rng = random.Random(12)
    text = text_of(rng, 3000)
    own = spark.createDataFrame([], "region long, rec_id string, seq string, qual string").coalesce(1)
    regions = spark.createDataFrame([(k, 0, 200 + 10 * k, 205 + 10 * k) for k in range(200)], "region long, contig_id int, lo long, hi long").coalesce(1)
    seen = []

    def counted(df):
        out = cut(df)
        if "haps" in df.columns:
            seen.append(out.groupBy(F.spark_partition_id()).count().count())
        return out

    cut, haplotypes.cut = haplotypes.cut, counted
    try:
        haplotypes.assembled(own, regions, reference(spark, [text])).count()
    finally:
        haplotypes.cut = cut
    assert seen[0] == 4


def test_leading_likelihoods_equal_whole_ones_and_few_pairs_are_worked_whole(monkeypatch):
    rng = random.Random(21)
    reads, quals, haps, groups = [], [], [], []
    for g in range(150):
        base = text_of(rng, 230)
        if g % 10 == 0:
            base = base[:60] + "ACG" * 30 + base[150:]
        own = [base, base[:110] + text_of(rng, 12) + base[110:], base[:110] + "ACGT"["ACGT".index(base[110]) - 1] + base[111:], base[:100] + base[140:]]
        if g % 17 == 0:
            own.append("")
        a = rng.randrange(150)
        read = rng.choice(own[:4])[a : a + rng.randint(1, 100)]
        for _ in range(g % 4):
            p = rng.randrange(len(read) + 1)
            read = read[:p] + rng.choice(["", "A", "N", "GT"]) + read[p + 1 :]
        read = read or "A"
        for h in own:
            reads.append(read)
            quals.append("".join(chr(33 + rng.choice([40, 40, 40, 30, 12, 2])) for _ in read) if h is own[0] else quals[-1])
            haps.append(h)
            groups.append(g)
    whole, asked = pairhmm.likelihoods, []
    want = whole(reads, quals, haps)
    monkeypatch.setattr(pairhmm, "likelihoods", lambda *x: asked.append(len(x[0])) or whole(*x))
    got = pairhmm.leading(reads, quals, haps, groups := np.array(groups), haplotypes.FLOOR)
    for g in range(150):
        best = max(want[groups == g])
        for x, y in zip(want[groups == g], got[groups == g]):
            assert max(x, best - haplotypes.FLOOR) == pytest.approx(max(y, best - haplotypes.FLOOR), abs=1e-6)
    asked.clear()
    base = text_of(rng, 230)
    own = [base, base[:110] + text_of(rng, 12) + base[110:]]
    clean = [own[k % 2][a : a + 70] for k, a in enumerate(range(0, 150, 3)) for _ in own]
    pairhmm.leading(clean, ["I" * 70] * 100, own * 50, np.arange(100) // 2, haplotypes.FLOOR)
    assert sum(asked) < 20


def test_words_as_numbers_equal_plain_counts(spark, monkeypatch):
    rng = random.Random(22)
    rows, want = [], {}
    for i in range(60):
        seq, qual = "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=rng.randint(1, 40))), "".join(rng.choices("I+*!", [9, 9, 1, 1], k=40))
        rows.append((i % 3 - 1, seq, qual[: len(seq)]))
        for k in range(len(seq) - 4):
            word = seq[k : k + 5]
            if "N" not in word and all(ord(q) - 33 >= haplotypes.LEAST_QUALITY for q in qual[k : k + 5]):
                want[i % 3 - 1, word] = want.get((i % 3 - 1, word), 0) + 1
    own = spark.createDataFrame(rows, "region long, seq string, qual string")
    numbers = {(r.region, r.word): r.n for r in haplotypes.words(own, 4, 1).collect()}
    assert numbers == want
    assert {(r.region, r.word): r.n for r in haplotypes.words(own, 4, 2).collect()} == {k: n for k, n in want.items() if n > 1}
    monkeypatch.setattr(haplotypes.sweep, "EXACT", 3)
    assert {(r.region, r.word): r.n for r in haplotypes.words(own, 4, 1).collect()} == want
