import math
import random

from regionflow.operators import joint
from regionflow.sources import sequence

SCHEMA = "sample string, contig_id int, pos long, end long, ref string, alts array<string>, pl array<int>, dp long"


def plain(records):
    """Genotypes of all samples at all places at which an allele is named, one by one."""
    out = []
    named = {}
    for _, c, pos, _, ref, alts, pl, _ in records:
        if pl is not None and c is not None and [a for a in alts if a != joint.NON_REF]:
            named.setdefault((c, pos), []).append((ref, alts))
    for (c, at), found in named.items():
        whole = max((r for r, _ in found), key=lambda r: (len(r), r))
        full = lambda a, r: a if a in ("*", joint.NON_REF) else a + whole[len(r) :]  # noqa: B023, E731
        alts = sorted({full(a, r) for r, own in found for a in own if a != joint.NON_REF})
        pairs = [(i, j) for j in range(len(alts) + 1) for i in range(j + 1)]
        rows, qual = [], 0.0
        for sample in sorted({r[0] for r in records}):
            cover = [r for r in records if r[0] == sample and r[1] == c and r[6] is not None and r[2] <= at <= (r[3] or r[2] + len(r[4]) - 1)]
            if not cover:
                continue
            _, _, pos, _, ref, own, pl, dp = max(cover, key=lambda r: (r[2], sum(a != joint.NON_REF for a in r[5])))
            own = [full(a, ref) for a in own] if pos == at else [a if a == joint.NON_REF else None for a in own]
            other = own.index(joint.NON_REF) + 1 if joint.NON_REF in own else None
            place = [0] + [own.index(a) + 1 if a in own else other for a in alts]
            new = []
            for i, j in pairs:
                a, b = place[i], place[j]
                k = None if a is None or b is None else max(a, b) * (max(a, b) + 1) // 2 + min(a, b)
                new.append(joint.UNTOLD if k is None or k >= len(pl) else pl[k])
            new = [x - min(new) for x in new]
            theta = joint.INDEL_HETEROZYGOUS if any(len(a) != len(whole) for a in alts) else joint.HETEROZYGOUS
            n = len(alts)
            w = [(1 - 1.5 * theta if j == 0 else theta / n if i == 0 else theta / (n * (n + 1))) * 10 ** (-p / 10) for (i, j), p in zip(pairs, new)]
            qual += -10 * math.log10(w[0] / sum(w))
            rows.append((c, at, whole, tuple(alts), sample, "%d/%d" % pairs[new.index(0)], min(99, sorted(new)[1]), tuple(new), dp))
        if any(r[5] != "0/0" for r in rows):
            out += [(*r, qual) for r in rows]
    return sorted(out)


def test_genotypes_equal_those_taken_one_by_one(spark):
    rng = random.Random(41)
    records = []
    for sample in ("a", "b", "c"):
        pos = 1
        while pos < 40_000:
            if rng.random() < 0.5:
                end = pos + (20_000 if rng.random() < 0.01 else rng.choice([0, 5, 300]))
                records.append((sample, rng.choice([0, 0, 1]), pos, end, "A", [joint.NON_REF], [0, rng.randint(3, 60), rng.randint(60, 600)], 30))
                pos = end + 1 - rng.choice([0, 0, 1])
            else:
                ref = rng.choice(["A", "ACG", "AC"])
                alts = sorted(set(rng.sample(["C", "G", "AT", "ACGT", "*", ref[0] + "TT"], rng.randint(1, 2)))) + [joint.NON_REF] * (rng.random() < 0.8)
                n = len(alts) + 1
                pl = [rng.randint(0, 400) for _ in range(n * (n + 1) // 2)]
                at = rng.choice([pos, pos - pos % 50 + 50])
                records.append((sample, rng.choice([0, 1]), at, rng.choice([at + len(ref) - 1, None]), ref, alts, [x - min(pl) for x in pl] if rng.random() < 0.95 else None, rng.choice([20, None])))
                pos = at + rng.randint(1, 400)
    records = list({(r[0], r[1], r[2], len(r[5]) > 1): r for r in records}.values())
    got = joint.genotype(spark.createDataFrame(records + [("a", None, 5, 9, "A", ["C"], [9, 0, 9], 1)], SCHEMA)).collect()
    rows = sorted((r.contig_id, r.pos, r.ref, tuple(r.alts), r["sample"], r.gt, r.gq, tuple(r.pl), r.dp, r.qual) for r in got)
    want = plain(records)
    assert [r[:-1] for r in rows] == [w[:-1] for w in want] and len(want) > 100
    assert all(abs(r[-1] - w[-1]) < 1e-3 for r, w in zip(rows, want))
    assert any(r[5] == "1/2" for r in rows)
    assert joint.genotype(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_are_genotyped_together(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    (tmp_path / "a.g.vcf").write_text(head + "one\nc1\t1\t.\tA\t<NON_REF>\t.\t.\tEND=99\tGT:DP:GQ:PL\t0/0:30:60:0,60,600\nc1\t100\t.\tC\tG,T,<NON_REF>\t50\t.\tDP=31\tGT:AD:DP:GQ:PL\t1/2:0,15,16,0:31:99:900,400,350,410,0,360,800,390,380,790\n")
    (tmp_path / "b.g.vcf").write_text(head + "two\nc1\t60\t.\tA\t<NON_REF>\t.\t.\tEND=200\tGT:DP:GQ:PL\t0/0:12:36:0,36,360\nc1\t300\t.\tG\t.\t.\t.\t.\tGT:PL\t./.:.\n")
    rows = sequence.gvcf(spark, str(tmp_path / "*.vcf")).withColumnRenamed("contig", "contig_id")
    assert {(r["sample"], r.pos, r.end, tuple(r.alts), r.pl and tuple(r.pl)) for r in rows.collect()} >= {("one", 1, 99, ("<NON_REF>",), (0, 60, 600)), ("two", 300, 300, (), None)}
    got = {r["sample"]: (r.pos, r.ref, tuple(r.alts), r.gt, tuple(r.pl), r.dp) for r in joint.genotype(rows).collect()}
    assert got == {"one": (100, "C", ("G", "T"), "1/2", (900, 400, 350, 410, 0, 360), 31), "two": (100, "C", ("G", "T"), "0/0", (0, 36, 360, 36, 360, 360), 12)}


def test_a_share_too_small_for_a_double_has_infinite_quality(spark):
    records = [("a", 0, 5, 5, "A", ["C", joint.NON_REF], [4405, 321, 0, 4405, 321, 4405], 110), ("b", 0, 5, 5, "A", ["C", joint.NON_REF], [0, 30, 300, 30, 300, 300], 10)]
    got = joint.genotype(spark.createDataFrame(records, SCHEMA)).collect()
    assert [(r.gt, r.qual) for r in sorted(got, key=lambda r: r["sample"])] == [("1/1", math.inf), ("0/0", math.inf)]
