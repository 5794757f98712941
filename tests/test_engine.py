import gzip
import io
import math
import random
import re
import struct
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators import bqsr, calling, dedup, genome, ingest, route, variants
from regionflow.plans import calls, pipeline, queries
from regionflow.sources import ingest as inputs
from regionflow.sources import sequence, text
from regionflow.streaming import ingest as streaming


def contigs(spark, *sizes):
    return spark.createDataFrame([(i, "ABCDEFG"[i], n) for i, n in enumerate(sizes)], "contig_id int, contig string, len long")


@pytest.mark.parametrize(
    "halo, want",
    [
        (0, {0: ["A:1-5"], 1: ["A:6-10"], 2: ["B:1-5"], 3: ["B:6-7", "C:1-3"]}),
        (1, {0: ["A:1-6"], 1: ["A:5-10", "B:1-1"], 2: ["A:10-10", "B:1-6"], 3: ["B:5-7", "C:1-3"]}),
        (2, {0: ["A:1-7"], 1: ["A:4-10", "B:1-2"], 2: ["A:9-10", "B:1-7"], 3: ["B:4-7", "C:1-3"]}),
    ],
)
def test_interval_goldens(spark, halo, want):
    got = {}
    for r in genome.intervals(contigs(spark, 10, 7, 3), 4, halo).orderBy("region", "contig_id").collect():
        got.setdefault(r.region, []).append(f"{r.contig}:{r.lo}-{r.hi}")
    assert got == want


def test_regions_that_run_out_are_empty_and_bases_owned_once(spark):
    rows = genome.intervals(contigs(spark, 10), 7).collect()
    assert sorted(x for r in rows for x in range(r.lo, r.hi + 1)) == list(range(1, 11))
    assert {r.region for r in rows} == set(range(5))


def test_routing_goldens(spark):
    iv = spark.createDataFrame([(0, 0, "A", 1, 110), (1, 0, "A", 90, 200), (0, 1, "B", 1, 50)], "region long, contig_id int, contig string, lo long, hi long")
    rows = [
        ("a", 65, 0, 10, "region"), ("a", 129, 0, 20, "region"), ("b", 65, 0, 10, "chri"), ("b", 129, 0, 150, "chri"),
        ("c", 65, 0, 100, "chri"), ("c", 129, 0, 10, "chri"), ("d", 65, 0, 10, "chri"), ("d", 129, 1, 10, "chri"),
        ("e", 69, 0, 10, "unmapped"), ("e", 129, 0, 10, "region"), ("f", 69, 0, 10, "unmapped"), ("f", 129, 0, 100, "chri"),
        ("g", 321, 0, 10, "region"), ("g", 2113, 0, 100, "chri"), ("h", 577, 0, 10, "qcfail"), ("i", 581, 0, 10, "unmapped"),
        ("j", 65, 0, 10, "region"), ("j", 129, 0, 150, "region"), ("j", 129, 0, 100, "chri"),
    ]
    reads = spark.createDataFrame([(f"{q}{i}", q, f, c, p) for i, (q, f, c, p, _) in enumerate(rows)], "rec_id string, qname string, flag int, contig_id int, pos long")
    got = {r.rec_id: r.dest for r in route.route(reads, iv).collect()}
    assert got == {f"{q}{i}": d for i, (q, *_, d) in enumerate(rows)}
    odd = spark.createDataFrame([("u1", "u", 77, None, None), ("u2", "u", 141, None, None), ("x", "x", 517, 0, 9999), ("y", "y", 577, None, None)], reads.schema)
    assert {r.rec_id: r.dest for r in route.route(odd, iv).collect()} == {"u1": "unmapped", "u2": "unmapped", "x": "unmapped", "y": "qcfail"}
    for place in ((0, 500), (9, 5), (None, None)):
        with pytest.raises(Exception, match="no region holds"):
            route.route(spark.createDataFrame([("z", "z", 65, *place)], reads.schema), iv).collect()
    with pytest.raises(Exception, match="no flag"):
        route.route(spark.createDataFrame([("z", "z", None, 0, 10)], reads.schema), iv).collect()


def test_reverse_complement_and_fastq(spark):
    df = spark.createDataFrame([("q", "ACGTN", "!!##$")], "n string, s string, q string")
    r = df.select(R.reverse_complement(F.col("s")).alias("r"), R.fastq(F.col("n"), F.lit(1), F.col("s"), F.col("q"), F.lit(True)).alias("f")).first()
    assert r.r == "NACGT" and r.f == "@q/1\nNACGT\n+\n$##!!"


def test_ingest_goldens(spark):
    rows = [("q", 65, 0), ("q", 65, 1), ("q", 129, 2), ("p", 65, 3), ("s", 833, 4)]
    reads = spark.createDataFrame([(a, b, f"r{c}", c) for a, b, c in rows], "qname string, flag int, rec_id string, n int")
    assert {r.qname: r.improper for r in ingest.improper(reads, ["n"]).collect()} == {"q": 1}
    assert tuple(ingest.counters(reads).first()) == (5, 1, 0)
    assert {r.qname: r.kind for r in ingest.name_classes(reads).collect()} == {"q": "ambiguous", "p": "orphan"}
    pairs = ingest.chunks(spark.range(10), ["id"], 4).groupBy("chunk_id").count().collect()
    assert {r.chunk_id: r["count"] for r in pairs} == {0: 4, 1: 4, 2: 2}


def test_text_sources(spark, tmp_path):
    (tmp_path / "batch").write_text("s1 a.bam\ns2 x_1.fq,x_2.fq\n")
    assert [tuple(r) for r in text.batch(spark, str(tmp_path / "batch")).collect()] == [("s1", "a.bam", None), ("s2", "x_1.fq", "x_2.fq")]
    assert text.config(["---", "# c", "a: 1", "b: ['x', \"y\"]", "...", "c: 2"]) == {"a": "1", "b": ["x", "y"]}
    for bad in (["abc:"], ["abcd"]):
        with pytest.raises(IndexError):
            text.config(bad)
    assert text.config(["a:", "url: 'http://h:1'", "x"]) == {"url": "http://h:1"}
    assert text.with_values("# a: 0\n---\na: 1\nab: 2\n...\n", {"a": "9", "z": "1"}) == '# a: 0\n---\na: "9"\nab: 2\n...\n'
    (tmp_path / "d").write_text("@HD\tVN:1\n@SQ\tSN:c1\tLN:10\n@SQ\tSN:HLA:2\tLN:5\n")
    assert [tuple(r) for r in text.sequence_dict(spark, str(tmp_path / "d")).orderBy("contig_id").collect()] == [(0, "c1", 10), (1, "HLA:2", 5)]
    (tmp_path / "iv").mkdir()
    (tmp_path / "iv" / "region_0.m3bp.intervals").write_text("HLA:2:1-5\n")
    assert [tuple(r) for r in text.read_intervals(spark, str(tmp_path / "iv"), 3000).collect()] == [("region_0", "HLA:2", 1, 5)]


SAM = "@HD\tVN:1\nq1\t99\tc1\t5\t60\t2S3M\t=\t9\t4\tACGTN\tIIIII\tNM:i:1\nq2\t256\t*\t0\t0\t*\t*\t0\t0\t*\t*\n"


def test_fastq_sam_vcf(spark, tmp_path):
    with gzip.open(tmp_path / "x.fq.gz", "wt") as f:
        f.write("@a/1\nACGT\n+\nIIII\n@b/2\nAC\n+\nII\n")
    assert [tuple(r) for r in sequence.fastq(spark, str(tmp_path / "x.fq.gz")).orderBy("n").collect()] == [(0, "a", 1, "ACGT", "IIII"), (1, "b", 2, "AC", "II")]
    (tmp_path / "x.sam").write_text(SAM)
    a, b = sequence.sam(spark, str(tmp_path / "x.sam")).collect()
    assert (a.rnext, [tuple(c) for c in a.cigar], a.tags["NM"].val) == ("c1", [("S", 2), ("M", 3)], "1") and b.rname is None and b.cigar == []
    (tmp_path / "x.vcf").write_text("##x\n#CHROM\nc1\t5\t.\tA\tC,G\t50\tPASS\tDP=3;AF=0.5\n")
    v = sequence.vcf(spark, str(tmp_path / "x.vcf")).first()
    assert (v.pos, v.alt, v.id, v.info["DP"]) == (5, ["C", "G"], None, "3")
    stream = streaming.contig_counts(streaming.passing_reads(spark, str(tmp_path / "*.sam")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [tuple(r) for r in spark.table("counts").collect()] == [("c1", 1)]


def test_bam(spark, tmp_path):
    rec = struct.pack("<iiBBHHHiiii", 0, 4, 3, 60, 0, 2, 99, 5, 0, 8, 4) + b"q1\0" + struct.pack("<2I", 2 << 4 | 4, 3 << 4) + bytes([0x12, 0x48, 0xF0]) + bytes([40] * 5)
    body = b"BAM\1" + struct.pack("<ii", 0, 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 100) + struct.pack("<i", len(rec)) + rec
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    (tmp_path / "x.bam").write_bytes(z.compress(body) + z.flush())
    assert tuple(sequence.bam(spark, str(tmp_path / "x.bam")).first())[:11] == ("q1", 99, "c1", 5, 60, "2S3M", "=", 9, 4, "ACGTN", "IIIII")


def test_large_bam_with_tags(spark, tmp_path):
    tags = b"NMC\x05XFf" + struct.pack("<f", 0.5) + b"RGZg1\0XHH0aff\0XBBs" + struct.pack("<i3h", 3, -1, 2, 300) + b"XAAq"
    body = b"BAM\1" + struct.pack("<ii", 0, 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 100)
    for i in range(12_000):
        name = f"q{i}".encode() + b"\0"
        rec = struct.pack("<iiBBHHHiiii", 0, i, len(name), 60, 0, 1, 65, 4, -1, -1, 0) + name + struct.pack("<I", 4 << 4) + bytes([0x12, 0x48]) + bytes([40] * 4) + tags
        body += struct.pack("<i", len(rec)) + rec
    out = b""
    for k in range(0, len(body), 60_000):  # members that end within records
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += z.compress(body[k : k + 60_000]) + z.flush()
    (tmp_path / "x.bam").write_bytes(out)
    got = sequence.bam(spark, str(tmp_path / "x.bam")).collect()
    assert [(r.qname, r.pos) for r in got] == [(f"q{i}", i + 1) for i in range(12_000)]
    t = got[-1].tags
    assert (t["NM"].i, t["XF"].f, t["RG"].val, bytes(t["XH"].h), t["XB"].b, t["XA"].val) == (5, 0.5, "g1", b"\x0a\xff", [-1, 2, 300], "q")
    reads = sequence.as_reads(sequence.bam(spark, str(tmp_path / "x.bam")), contigs(spark, 20_000).selectExpr("contig_id", "'c1' as contig"))
    assert (reads.select("rec_id").distinct().count(), reads.first().rg, reads.first().contig_id) == (12_000, "g1", 0)


def test_stages_are_not_run_twice(spark, tmp_path):
    ran = []
    stages = [("a", lambda d: ran.append("a") or d.selectExpr("id + 1 as id")), ("b", lambda d: ran.append("b") or d.where("id > 2"))]
    for _ in range(2):
        assert pipeline.run(spark, spark.range(5), stages, str(tmp_path)).count() == 3
    assert ran == ["a", "b"]


def test_numbering_over_many_partitions(spark):
    rows = spark.range(20_000, numPartitions=7).selectExpr("id", "id * 7919 % 20000 as k")
    assert ingest.numbered(rows, ["k"]).where("n <> k").count() == 0


def test_strand_annotations(spark):
    tables = [(3, 1, 1, 3), (10, 0, 0, 10), (5, 5, 5, 5), (7, 0, 3, 0), (0, 0, 0, 2), (400, 3, 2, 390)]
    df = spark.createDataFrame(tables, "a long, b long, c long, d long")
    table = [F.col(c) for c in "abcd"]
    got = df.select(*table, calling.fisher_phred(*table).alias("fs"), calling.strand_odds(*table).alias("sor")).collect()

    def slow(a, b, c, d):
        way = lambda k: Fraction(math.comb(a + b, k) * math.comb(c + d, a + c - k), math.comb(a + b + c + d, a + c))
        every = [way(k) for k in range(max(0, a - d), min(a + b, a + c) + 1)]
        p = sum(x for x in every if x <= way(a))
        return -10 * (math.log10(p.numerator) - math.log10(p.denominator))

    for r in got:
        assert r.fs == pytest.approx(slow(r.a, r.b, r.c, r.d), abs=1e-3)
    assert {(r.a, r.b): r.sor for r in got}[(5, 5)] == pytest.approx(math.log(2), abs=1e-4)


def test_bad_sites_score_below_good_ones(spark):
    rows = [(i, 30.0 + i % 5, 50.0 + i % 7, i % 3 == 0, 10) for i in range(100)] + [(100 + i, 5.0 + i % 2, 20.0 - i % 3, False, 0) for i in range(6)]
    df = spark.createDataFrame(rows, "id int, x double, y double, train boolean, prior int")
    got = {r.id: r.vqslod for r in variants.vqslod(df, ["x", "y"], "train", "prior").collect()}
    assert len(got) == 106 and max(got[i] for i in range(100, 106)) < min(got[i] for i in range(100))
    with pytest.raises(ValueError):
        variants.vqslod(df.where("not train"), ["x", "y"], "train", "prior")


def test_inputs_of_every_kind(spark, tmp_path):
    one, two = "@a/1\nAC\n+\nIJ\n@b/1\nGG\n+\nKL\n", "@a/2\nTT\n+\nMN\n@b/2\nCA\n+\nOP\n@c/2\nA\n+\nI\n"
    (tmp_path / "x_1.fq").write_text(one)
    (tmp_path / "x_2.fq").write_text(two)
    (tmp_path / "mixed.fastq").write_text("@a/1\nAC\n+\nIJ\n@a/2\nTT\n+\nMN\n@b/1\nGG\n+\nKL\n@b/2\nCA\n+\nOP\n@c/1\nA\n+\nI\n")
    sam = "@HD\tVN:1.5\n@HD\tSO:unsorted\n@SQ\tSN:c:1\tLN:9\n@CO\tfree: text\n"
    for name, flag, seq, qual in (("a", 65, "AC", "IJ"), ("a", 145, "AA", "NM"), ("b", 65, "GG", "KL"), ("b", 129, "CA", "OP"), ("c", 65, "A", "I"), ("d", 321, "A", "I"), ("d", 129, "A", "I")):
        sam += f"{name}\t{flag}\tc:1\t1\t9\t{len(seq)}M\t*\t0\t0\t{seq}\t{qual}\n"
    (tmp_path / "x.sam").write_text(sam)
    want = [("a", "AC", "IJ", "TT", "MN"), ("b", "GG", "KL", "CA", "OP")]
    for spec in (f"{tmp_path}/x_1.f*,{tmp_path}/x_2.f*", f"{tmp_path}/mixed.fastq", f"{tmp_path}/x.sam"):
        assert sorted(map(tuple, inputs.read_pairs(spark, spec).collect())) == want
    assert inputs.resolve(spark, f"{tmp_path}/x.sam")[0] == "aligned"
    for spec in (f"{tmp_path}/none*", f"{tmp_path}/x_*.fq,{tmp_path}/x_1.fq", f"{tmp_path}/x*"):
        with pytest.raises(ValueError):
            inputs.resolve(spark, spec)
    inputs.write_pairs(inputs.read_pairs(spark, f"{tmp_path}/x.sam"), f"{tmp_path}/out")
    again = inputs.read_pairs(spark, f"{tmp_path}/out/mate=1/*.gz,{tmp_path}/out/mate=2/*.gz")
    assert sorted(map(tuple, again.collect())) == want
    head = {r.kind: r.fields for r in sequence.sam_header(spark, str(tmp_path / "x.sam")).collect()}
    assert head == {"HD": {"VN": "1.5", "SO": "unsorted"}, "SQ": {"SN": "c:1", "LN": "9"}, "CO": {"text": "free: text"}}


def test_recalibration_follows_cycle_and_context(spark):
    schema = "rec_id string, contig_id int, rpos long, cycle int, flag int, bq int, ref_base string, base_call string"
    # G after C in cycle 3 of the first mate is always wrong, the other bases never are.
    rows = [(f"a{i}", 0, 10 + k, k, 65, 30, "ACA"[k - 1], "ACG"[k - 1]) for i in range(50) for k in (1, 2, 3)]
    rows += [(f"b{i}", 0, 10 + k, k, 129, 30, "ATA"[k - 1], "ATA"[k - 1]) for i in range(50) for k in (1, 2, 3)]
    bases = spark.createDataFrame([*rows, ("c", 0, 50, 1, 65, 40, "A", "A"), ("c", 0, 51, 2, 65, 3, "A", "T")], schema)
    table = bqsr.marginals(bqsr.covariates(bases.where("rec_id <> 'c'")))
    got = {(r.rec_id[0], r.cycle): r.new_q for r in bqsr.apply(bases, table).collect()}
    emp = lambda err, obs: round(-10 * math.log10((err + 1) / (obs + 2)), 4)
    q = emp(50, 300)
    want = {("c", 1): math.floor(40 + q - 30 + 0.5), ("c", 2): 3}
    for mate, cycle, fails, context in (("a", 1, 0, None), ("a", 2, 0, 0), ("a", 3, 50, 50), ("b", 1, 0, None), ("b", 2, 0, 0), ("b", 3, 0, 0)):
        shift = emp(fails, 50) - q + (0 if context is None else emp(context, 50) - q)
        want[mate, cycle] = max(1, min(60, math.floor(q + shift + 0.5)))
    assert got == want and got["a", 3] < got["a", 2]
    assert bqsr.apply(bases, table).count() == bases.count()
    empty = bqsr.apply(bases, table.limit(0))
    assert empty.where("new_q <> bq").count() == 0 and empty.count() == bases.count()


def test_a_table_of_over_256_qualities_is_not_cut(spark):
    table = spark.range(300).selectExpr("cast(id as int) as q", "cast(10 as double) as emp_q")
    bases = spark.range(6, 300).selectExpr("cast(id as int) as bq")
    assert bqsr.apply_quality(bases, table).where("new_q <> 10").count() == 0


def test_a_split_alignment_does_not_cost_its_pair(spark, tmp_path):
    records = [
        ("a", 65, "ACGT", "IJKL"), ("a", 2113, "GT", "KL"), ("a", 145, "AA", "NM"),  # R1, its supplementary part, R2
        ("b", 65, "GG", "KL"), ("b", 129, "CATT", "OPQR"), ("b", 2193, "AA", "RQ"), ("b", 2177, "T", "Q"),  # two of R2
        ("c", 65, "A", "I"), ("c", 2177, "C", "J"),  # no R2 but a supplementary part
        ("d", 65, "A", "I"), ("d", 65, "C", "J"), ("d", 129, "G", "K"),  # two of R1 that are not supplementary
    ]
    (tmp_path / "x.sam").write_text("".join(f"{name}\t{flag}\tc1\t1\t9\t{len(seq)}M\t*\t0\t0\t{seq}\t{qual}\n" for name, flag, seq, qual in records))
    got = sorted(map(tuple, inputs.read_pairs(spark, f"{tmp_path}/x.sam").collect()))
    assert got == [("a", "ACGT", "IJKL", "TT", "MN"), ("b", "GG", "KL", "CATT", "OPQR")]


READS = "rec_id string, qname string, flag int, contig_id int, pos long, cigar string, seq string, qual string"


def slow_bases(rec, pos, cigar, seq, qual):
    out, at = [], 0
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        for _ in range(int(n)):
            if op in "M=X" and seq[at] != "N":
                out.append((rec, pos, at + 1, ord(qual[at]) - 33, seq[at], seq[at - 1] if at else None))
            at += op in "MIS=X"
            pos += op in "MDN=X"
    return out


def test_reads_become_bases_by_their_cigar(spark):
    seq, qual = "ACGTNACGGTCATTGACNGTACCATGACTTGA", "".join(chr(33 + k) for k in range(32))
    cigars = ["5S27M", "20M2I10M", "20M3D9M3S", "32M", "2H3S10M5N4=1X0M12M2S1H", "1I30M1S", "32S"]
    rows = [(f"r{i}", f"q{i}", 65, 1, 100, c, seq, qual) for i, c in enumerate(cigars)]
    rows += [(f"f{f}", f"f{f}", f, 1, 100, "32M", seq, qual) for f in (69, 321, 577, 1089)]  # unmapped, secondary, failing, duplicate
    rows += [("s", "s", 2113, 1, 100, "32M", seq, qual), ("n1", "n1", 65, 1, 100, "*", seq, qual), ("n2", "n2", 65, 1, 100, "32M", seq, "*"), ("n3", "n3", 65, 1, 100, "32M", "*", "*")]
    got = bqsr.explode(spark.createDataFrame(rows, READS))
    assert got.columns == ["rec_id", "qname", "flag", "contig_id", "rpos", "cycle", "bq", "base_call", "before"]
    want = [b for i, c in enumerate(cigars) for b in slow_bases(f"r{i}", 100, c, seq, qual)] + slow_bases("s", 100, "32M", seq, qual)
    key = lambda r: (r[0], r[2])
    assert sorted((tuple(r) for r in got.select("rec_id", "rpos", "cycle", "bq", "base_call", "before").collect()), key=key) == sorted(want, key=key)
    ctx = {(r.rec_id, r.cycle): r.ctx for r in bqsr.with_covariates(got).collect()}
    assert (ctx["r0", 7], ctx["r0", 6], ctx["r1", 23], ctx["r3", 1]) == ("AC", None, seq[21] + seq[22], None)
    with pytest.raises(Exception, match="lengths differ"):
        bqsr.explode(spark.createDataFrame([("x", "x", 65, 1, 1, "31M", seq, qual)], READS)).collect()


def test_duplicates_leave_no_bases(spark):
    row = lambda rec, q: (rec, rec, 65, 1, 100, "4M", "ACGT", q * 4)
    reads = spark.createDataFrame([row("a", "I"), row("b", "5"), ("c", "c", 65, 1, 101, "4M", "ACGT", "5555"), ("u", "u", 69, 1, 100, "4M", "ACGT", "5555")], READS)
    marked = dedup.flagged(reads)
    assert {r.rec_id: r.flag for r in marked.collect()} == {"a": 65, "b": 65 + 1024, "c": 65, "u": 69} and marked.columns == reads.columns
    assert {r.rec_id for r in bqsr.explode(marked).collect()} == {"a", "c"}


def test_whole_reads_are_counted_and_zipped():
    assert {"region_empty", "zip_pairs"} <= set(queries.ORACLES)


def test_empty_regions_are_told(spark):
    reads = spark.createDataFrame([(0, 1), (0, 2), (0, 9), (1, 7)], "contig_id int, pos long")
    n = genome.points_in(reads, genome.intervals(contigs(spark, 10, 7, 3), 6)).groupBy("region").agg(F.count("*").alias("n"))
    regions = spark.range(6).withColumnRenamed("id", "region")
    assert {r.region: r.n for r in genome.with_empty(regions, n).collect()} == {0: 2, 1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_unequal_files_are_zipped_as_far_as_both_go(spark):
    file = lambda k, names: spark.createDataFrame([(i, f"{name} {k}", f"{name}{k}") for i, name in enumerate(names)], "n long, name string, rec_id string")
    for a, b in (("pqrs", "pq"), ("pq", "pqrs")):
        assert sorted(map(tuple, ingest.zip_pairs(file(1, a), file(2, b)).collect())) == [(0, "p", "p1", "p2"), (1, "q", "q1", "q2")]
    with pytest.raises(Exception, match="names differ"):
        ingest.zip_pairs(file(1, "pq"), file(2, "pr")).collect()


def test_regions_are_written_and_read_in_order(spark, tmp_path):
    iv = genome.intervals(contigs(spark, 300, 200), 4)
    rows = [(f"r{i}", f"q{i // 2}", 65 if i % 2 == 0 else 129, i % 2, 1 + i * 7 % 190) for i in range(60)] + [("u", "u", 69, None, None)]
    reads = spark.createDataFrame(rows, "rec_id string, qname string, flag int, contig_id int, pos long")
    routed = route.route(reads, iv)
    route.write_regions(reads, routed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.rec_id, r.dest, r.region) for r in back.select("rec_id", "dest", "region").collect()} == {tuple(r) for r in routed.collect()}
    route.write_sorted(reads, f"{tmp_path}/sorted")
    assert spark.read.parquet(f"{tmp_path}/sorted").count() == 61
    whole = [(r.contig_id, r.pos, r.rec_id) for r in route.ordered_concat(reads, iv).orderBy("place").collect()]
    assert whole == sorted((c, p, i) for i, _, _, c, p in rows if c is not None)
    inside = genome.restricted(reads.where("pos is not null").withColumnRenamed("pos", "rpos"), iv.where("region = 0"))
    assert inside.count() == sum(c == 0 and p <= 125 for *_, c, p in rows) and "pos" not in inside.columns


def test_context_beside_a_masked_site_is_the_reads_own(spark):
    schema = "rec_id string, contig_id int, rpos long, cycle int, flag int, bq int, ref_base string, base_call string"
    bases = spark.createDataFrame([("r", 0, k, k, 65, 30, "ACGT"[k - 1], "ACGT"[k - 1]) for k in (1, 2, 3, 4)], schema)
    known = spark.createDataFrame([(0, 2, "C"), (0, 4, "TAA"), (None, 1, "A")], "contig_id int, pos long, ref string")
    got = {r.rpos: r.ctx for r in bqsr.unknown_only(bqsr.covariates(bases), known).collect()}
    assert got == {1: None, 3: "CG"}
    span = spark.createDataFrame([(0, 2, "CGT"), (0, 9, None)], known.schema)
    assert [r.rpos for r in bqsr.unknown_only(bqsr.covariates(bases), span).collect()] == [1]


def test_qualities_are_rewritten_where_bases_have_new_ones(spark):
    reads = spark.createDataFrame([("a", "IIII", 1), ("b", "5555", 2)], "rec_id string, qual string, x int")
    new = spark.createDataFrame([("a", 2, 10), ("a", 4, 60)], "rec_id string, cycle int, new_q int")
    out = bqsr.rewrite(reads, new)
    assert out.columns == reads.columns and {r.rec_id: r.qual for r in out.collect()} == {"a": "I+I]", "b": "5555"}


def test_read_groups_shift_apart(spark):
    schema = "rg string, contig_id int, rpos long, flag int, bq int, ref_base string, base_call string, rec_id string, cycle int"
    rows = [("x", 0, i, 65, 30, "A", "A" if i % 10 else "C", f"x{i}", 1) for i in range(100)] + [("y", 0, i, 65, 30, "A", "A", f"y{i}", 1) for i in range(100)] + [(None, 0, i, 65, 30, "A", "A", f"n{i}", 1) for i in range(50)]
    bases = spark.createDataFrame(rows, schema)
    got = {r.rg: r.new_q for r in bqsr.apply(bases, bqsr.marginals(bqsr.covariates(bases, "rg"), "rg"), "rg").select("rg", "new_q").distinct().collect()}
    emp = lambda err, obs: math.floor(round(-10 * math.log10((err + 1) / (obs + 2)), 4) + 0.5)
    assert got == {"x": emp(10, 100), "y": emp(0, 100), None: emp(0, 50)}


def test_reference_and_names_and_tags(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">c1 first\nACGTA\nCGTNN\nac\n>c2\nGG\n\n>c3\nTTTT\n")
    ref = sequence.fasta(spark, str(tmp_path / "r.fa"))
    assert sorted(map(tuple, ref.collect())) == [(0, "c1", 0, 5, "ACGTA"), (0, "c1", 1, 5, "CGTNN"), (0, "c1", 2, 5, "AC"), (1, "c2", 0, 2, "GG"), (2, "c3", 0, 4, "TTTT")]
    assert sorted(map(tuple, sequence.contigs_of(ref).collect())) == [(0, "c1", 12), (1, "c2", 2), (2, "c3", 4)]
    bases = spark.createDataFrame([(0, k) for k in range(1, 14)] + [(1, 2), (5, 1)], "contig_id int, rpos long")
    got = "".join(r.ref_base for r in sequence.with_reference(bases, ref).orderBy("contig_id", "rpos").collect())
    assert got == "ACGTACGTACG"
    (tmp_path / "bad.fa").write_text(">c1\nACG\nACGT\n")
    with pytest.raises(Exception, match="uneven"):
        sequence.fasta(spark, str(tmp_path / "bad.fa")).collect()
    names = spark.createDataFrame([("@a/1",), ("@b2",), ("@c",)], "x string").select(R.read_name(F.col("x")).alias("y")).select("y.*")
    assert [tuple(r) for r in names.collect()] == [("a", 1), ("b2", 2), ("c", None)]
    (tmp_path / "e.fq").write_text("@a/1\nA\n+\nI\n\n@b/1\nC\n+\nI\n")
    assert [r.qname for r in sequence.fastq(spark, str(tmp_path / "e.fq")).collect()] == ["a"]
    tag = lambda *f: spark.createDataFrame([(list(f),)], "f array<string>").select(R.tags(F.col("f")).alias("t")).first().t
    assert tag("NM:i:1", "NM:i:7", "XZ:Z:a:b")["NM"].i == 7 and tag("XZ:Z:a:b")["XZ"].val == "a:b" and tag() == {}
    for wrong in ("NM:i:x", "NM:q:1"):
        with pytest.raises(Exception):
            tag(wrong)


def test_sinks(spark, tmp_path):
    reads = spark.createDataFrame([("a", 65, "AC", "IJ"), ("a", 145, "AA", "NM"), ("c", 65, "G", "K"), ("d", 833, "G", "K")], "qname string, flag int, seq string, qual string")
    sequence.write_unpaired(reads, f"{tmp_path}/lone")
    assert [tuple(r)[1:] for r in sequence.fastq(spark, f"{tmp_path}/lone/mate=1/*.gz").collect()] == [("c", 1, "G", "K")]
    sequence.write_fastq(reads, f"{tmp_path}/all")
    assert [tuple(r)[1:] for r in sequence.fastq(spark, f"{tmp_path}/all/mate=2/*.gz").collect()] == [("a", 2, "TT", "MN")]
    c = contigs(spark, 10, 7, 3)
    text.write_interval_files(c, 4, f"{tmp_path}/iv", 1)
    for k in range(4):
        want = {(f"region_{r.region}", r.contig, r.lo, r.hi) for r in genome.intervals(c, 4, k).collect()}
        assert {tuple(r) for r in text.read_interval_files(spark, f"{tmp_path}/iv", k).collect()} == want
    lines = [f"q\t65\tA\t{i}\t9\t2M\t*\t0\t0\tAC\tIJ\tRG:Z:g" for i in (1, 2)] + ["u\t77\t*\t0\t0\t*\t*\t0\t0\tA\tI"]
    got = sequence.as_reads(sequence.parse_sam(spark.createDataFrame([(x,) for x in lines], "value string")), c, "s").orderBy("rec_id").collect()
    assert [(r.contig_id, r.pos, r.cigar, r.rg) for r in got] == [(0, 1, "2M", "g"), (0, 2, "2M", "g"), (None, None, "*", "s")]
    with pytest.raises(Exception, match="not in the dictionary"):
        sequence.as_reads(sequence.parse_sam(spark.createDataFrame([(lines[0].replace("\tA\t", "\tZ\t"),)], "value string")), c)
    calls = spark.createDataFrame([(1, "B", 5, None, "A", ["C", "G"], 50.0, ["PASS"], {"DP": "3"}, "0/1"), (0, "A", 9, "rs1", "T", ["C"], None, None, {}, "1/1")], "contig_id int, contig string, pos long, id string, ref string, alt array<string>, qual double, filter array<string>, info map<string,string>, sample string")
    sequence.vcf_text(calls, c, "s1").write.text(f"{tmp_path}/vcf")
    whole = "".join(f.read_text() for f in sorted((tmp_path / "vcf").glob("part-*"))).splitlines()
    assert whole[0] == "##fileformat=VCFv4.2" and whole[5:9] == ["##contig=<ID=A,length=10>", "##contig=<ID=B,length=7>", "##contig=<ID=C,length=3>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1"]
    assert whole[9:] == ["A\t9\trs1\tT\tC\t.\t.\t.\tGT\t1/1", "B\t5\t.\tA\tC,G\t50.0\tPASS\tDP=3\tGT\t0/1"]
    sites = sequence.known_sites(spark, {"x": f"{tmp_path}/vcf", "y": f"{tmp_path}/vcf"})
    assert sites.groupBy("source").count().count() == 2 and sites.count() == 4
    assert ingest.counters_with_improper(spark.createDataFrame([("q", 65, 0), ("q", 65, 1), ("q", 129, 2)], "qname string, flag int, n int"), ["n"]).first().improper == 1


def test_modes_are_recalibrated_apart(spark):
    rows = [(i, "SNP" if i < 60 else "INDEL", 30.0 + i % 5 + (50 if i >= 60 else 0), 9.0 + i % 7, i % 3 == 0, i % 3 == 0, 10) for i in range(120)]
    rows += [(200, "SNP", -9.0, 1.0, False, False, 0), (201, "INDEL", 31.0, 1.0, False, False, 0), (202, None, 1.0, 1.0, True, True, 0)]
    sites = spark.createDataFrame(rows, "id int, mode string, x double, y double, is_training boolean, is_truth boolean, prior int")
    got = {r.id: r for r in variants.recalibrate(sites, ["x", "y"], k=1).collect()}
    assert len(got) == 123 and got[200].filter == got[201].filter == "VQSRTranche99.0" and (got[202].filter, got[202].vqslod) == (None, None)
    assert sum(r.filter == "PASS" for r in got.values()) >= 100
    none = variants.recalibrate(sites.where("not is_training"), ["x", "y"])
    assert none.where("filter is not null").count() == 0 and none.count() == sites.where("not is_training").count()


def test_third_bases_and_alleles(spark):
    schema = "contig_id int, rpos long, ref_base string, base_call string, bq int"
    rows = [(0, 1, "A", b, 30) for b in "AAAAGGGGC"] + [(0, 2, "A", "T", 30)] * 4 + [(0, 3, "A", "A", 30)] * 5 + [(0, 4, "A", "C", 10)]
    got = {r.rpos: (r.alt, r.dp, r.ad_ref, r.ad_alt, r.gt) for r in calling.allele_genotypes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("G", 9, 4, 4, "0/1"), 2: ("T", 4, 0, 4, "1/1"), 3: (None, 5, 5, 0, "0/0")}
    reads = spark.createDataFrame([(f"r{i}", 65, 0, 1 + i, "10M2D10M" if i < 2 else "22M") for i in range(4)], "rec_id string, flag int, contig_id int, pos long, cigar string")
    ev = {r.pos: (r.op, r.len, r.n, r.dp, r.gt) for r in calling.indel_genotypes(reads).collect()}
    assert ev == {10: ("D", 2, 1, 4, "0/1"), 11: ("D", 2, 1, 4, "0/1")}


def test_files_become_calls(spark, tmp_path):
    rng = random.Random(5)
    chosen = {c: "".join(rng.choices("ACGT", k=5000)) for c in ("one", "two")}
    (tmp_path / "r.fa").write_text("".join(f">{c}\n" + "".join(s[i : i + 50] + "\n" for i in range(0, 5000, 50)) for c, s in chosen.items()))
    planted = {c: (chosen[c][2499], "ACGT"["ACGT".index(chosen[c][2499]) - 2]) for c in chosen}
    lines, depth = ["@HD\tVN:1.6"], 0
    for k in range(6000):
        contig, at = ("one", "two")[k % 2], 1 + k // 4 * 3
        seq = list(chosen[contig][at - 1 : at + 49])
        if 0 <= 2500 - at < 50:
            depth += contig == "one"
            if contig == "one" or k % 8 > 3:  # one letter in all reads, the other in half of them
                seq[2500 - at] = planted[contig][1]
        line = "\t".join([str(k // 2 % 2 * 16), contig, str(at), "60", f"{len(seq)}M", "*", "0", "0", "".join(seq), "I" * len(seq)])
        lines += [f"q{k}\t{line}"] + [f"copy{k}\t{line}"] * (0 <= 2500 - at < 50)
    lines.append("\t".join(["lost", "4", "*", "0", "0", "*", "*", "0", "0", "ACGT", "IIII"]))
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    (tmp_path / "known.vcf").write_text("##fileformat=VCFv4.2\n" + "\t".join(["one", "2500", "rs1", *planted["one"], ".", ".", "."]) + "\n")
    out = [r.value for r in calls.run(spark, str(tmp_path / "a.sam"), str(tmp_path / "r.fa"), str(tmp_path / "run"), {"dbsnp": str(tmp_path / "known.vcf")}).collect()]
    assert [x for x in out if x.startswith("##contig")] == ["##contig=<ID=one,length=5000>", "##contig=<ID=two,length=5000>"]
    rows = [x.split("\t") for x in out if not x.startswith("#")]
    assert [(r[0], r[1], (r[3], r[4]), r[9].split(":")[0]) for r in rows] == [("one", "2500", planted["one"], "1/1"), ("two", "2500", planted["two"], "0/1")]
    assert rows[0][7] == f"DP={depth}" and rows[0][2] == "rs1" and rows[1][2] == "."  # copies are not counted
    (tmp_path / "two.intervals").write_text("@HD\n\ntwo:2400-2600\n")
    with pytest.raises(ValueError, match="other inputs"):
        calls.run(spark, str(tmp_path / "a.sam"), str(tmp_path / "r.fa"), str(tmp_path / "run"), None)
    less = calls.run(spark, str(tmp_path / "a.sam"), str(tmp_path / "r.fa"), str(tmp_path / "less"), None, intervals=str(tmp_path / "two.intervals")).collect()
    assert [r.value.split("\t")[:2] for r in less if not r.value.startswith("#")] == [["two", "2500"]]


def test_a_folder_of_other_inputs_is_refused(spark, tmp_path):
    one, two = tmp_path / "a.txt", tmp_path / "b.txt"
    one.write_text("1\n")
    two.write_text("2\n")
    stages = [("a", lambda d: d.selectExpr("id + 1 as id"))]
    told = lambda p, **k: pipeline.fingerprint(spark, [str(p)], **k)
    folder = str(tmp_path / "run")
    for _ in range(2):
        assert pipeline.run(spark, spark.range(5), stages, folder, made_from=told(one, least=3)).count() == 5
    for other in (told(two, least=3), told(one, least=4)):
        with pytest.raises(ValueError, match="other inputs"):
            pipeline.run(spark, spark.range(9), stages, folder, made_from=other)
    pipeline.run(spark, spark.range(5), stages, str(tmp_path / "old"))
    with pytest.raises(ValueError, match="unknown inputs"):
        pipeline.run(spark, spark.range(5), stages, str(tmp_path / "old"), made_from=told(one))
    with pytest.raises(ValueError, match="no such input"):
        told(tmp_path / "none*")


def test_reads_without_names_are_alone(spark):
    schema = "rec_id string, qname string, flag int, contig_id int, pos long, cigar string, qual string"
    rows = [(f"r{i}", None, 65 if i % 2 else 129, 0, 10, "4M", "IIII") for i in range(2)] + [("p1", "p", 65, 0, 10, "4M", "II5I"), ("p2", "p", 129, 0, 50, "4M", "IIII")]
    reads = spark.createDataFrame(rows, schema)
    got = {r.rec_id: (r.is_pair, r.duplicate) for r in dedup.mark(reads).collect()}
    assert got == {"r0": (False, True), "r1": (False, True), "p1": (True, False), "p2": (True, False)}
    assert sorted((r.qname or "", r.kind) for r in ingest.name_classes(reads).collect()) == [("", "orphan"), ("", "orphan"), ("p", "pair")]
    assert [tuple(r) for r in ingest.pairs(reads).collect()] == [("p", "p1", "p2")]
    assert {r.rec_id for r in ingest.unpaired(reads).collect()} == {"r0", "r1"}


def test_alleles_stand_leftmost_and_are_named(spark):
    rng = random.Random(21)
    text_ = "".join(rng.choices("ACGT", k=60)) + "CA" * 400 + "".join(rng.choices("ACGT", k=60))
    width = 50
    reference = spark.createDataFrame([(0, "one", k // width, width, text_[k : k + width]) for k in range(0, len(text_), width)], "contig_id int, contig string, line long, width int, seq string")
    start = next(i for i in range(len(text_)) if text_[i : i + 790] == ("CA" * 400)[:790] or text_[i : i + 790] == ("AC" * 400)[:790])
    rows = [(0, 701, text_[700:703], text_[700], "far"), (0, 31, text_[30], "ACGT"["ACGT".index(text_[30]) - 1].lower(), "snp"), (0, 9000, "AC", "A", "beyond"), (1, 5, "AC", "A", "none"), (None, 5, "AC", "A", "null"), (0, 5, "A", "<DEL>", "odd")]
    got = {r.name: (r.pos, r.ref, r.alt) for r in variants.left_aligned(spark.createDataFrame(rows, "contig_id int, pos long, ref string, alt string, name string"), reference, 64).collect()}
    pos, ref, alt = got["far"]
    assert pos == start and len(ref) == 3 and alt == text_[start - 1] == ref[0]  # the base before the repeat
    assert text_[: pos - 1] + alt + text_[pos + 2 :] == text_[:700] + text_[700] + text_[703:]
    assert got["snp"] == (31, text_[30], "ACGT"["ACGT".index(text_[30]) - 1]) and got["odd"] == (5, "A", "<DEL>") and got["null"][0] == 5 and got["none"] == (5, "AC", "A")
    known = spark.createDataFrame([(0, 301, text_[300:303], [text_[300]], "rs9"), (0, 31, text_[30], ["N", "ACGT"["ACGT".index(text_[30]) - 1]], "rs2;rs1"), (0, 31, text_[30], ["ACGT"["ACGT".index(text_[30]) - 2]], "rs3"), (0, 60, "A", ["C"], None)], "contig_id int, pos long, ref string, alt array<string>, id string")
    calls_ = spark.createDataFrame([(0, pos, ref, [alt, "*"]), (0, 31, text_[30], ["ACGT"["ACGT".index(text_[30]) - 1]]), (0, 60, "A", ["G"])], "contig_id int, pos long, ref string, alts array<string>")
    assert {r.pos: r.id for r in variants.with_ids(calls_, known, reference).collect()} == {pos: "rs9", 31: "rs1;rs2", 60: None}
    sites = spark.createDataFrame([(0, 31, "A", ["C", "G"], "x")], "contig_id int, pos long, ref string, alt array<string>, source string")
    one = spark.createDataFrame([(0, 31, "A", "G"), (0, 31, "A", "T")], "contig_id int, pos long, ref string, alt string")
    assert {r.alt: r.source for r in variants.annotate(one, sites).collect()} == {"G": "x", "T": None}


def test_bases_over_the_reference_equal_a_join_by_base(spark):
    rng = random.Random(22)
    text_ = "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=1500))
    reference = spark.createDataFrame([(0, "one", k // 70, 70, text_[k : k + 70]) for k in range(0, 1500, 70)], "contig_id int, contig string, line long, width int, seq string")
    rows = [(f"r{i}", 0, 1 + rng.randint(0, 1450), 0, rng.choice([0, 30, None]), rng.choice(["50M", "5S20M3D25M", "20M6I24M"]), "".join(rng.choices("ACGT", k=50)), "I" * 50) for i in range(200)]
    reads = spark.createDataFrame(rows, "rec_id string, contig_id int, pos long, flag int, mapq int, cigar string, seq string, qual string")
    known = spark.createDataFrame([(0, rng.randint(1, 1500), rng.choice(["A", "ACGTA", None])) for _ in range(60)] + [(None, 3, "A"), (0, None, "A")], "contig_id int, pos long, ref string")
    want = sequence.with_reference(bqsr.explode(reads), reference)
    masked = {tuple(r) for r in want.select("rec_id", "cycle", "rpos", "ref_base", "base_call").collect()} - {tuple(r) for r in bqsr.unknown_only(want, known).select("rec_id", "cycle", "rpos", "ref_base", "base_call").collect()}
    got = bqsr.over_reference(reads, reference, known)
    assert sorted(tuple(r) for r in got.select("rec_id", "cycle", "rpos", "ref_base", "base_call").collect()) == sorted(tuple(r) for r in want.select("rec_id", "cycle", "rpos", "ref_base", "base_call").collect())
    assert {tuple(r) for r in got.where("masked").select("rec_id", "cycle", "rpos", "ref_base", "base_call").collect()} == masked and masked
    assert {r.mapq for r in bqsr.over_reference(reads, reference, None, 20).select("mapq").distinct().collect()} == {30}


def test_fractions_in_tags(spark):
    row = spark.createDataFrame([(["XF:B:f,0.5,-2,1e3", "XI:B:s,1,-2"],)], "t array<string>").select(R.tags(F.col("t")).alias("t")).first().t
    assert row["XF"].d == [0.5, -2.0, 1000.0] and row["XF"].b is None and row["XI"].b == [1, -2] and row["XI"].d is None


def blocked(body, sizes):
    """body as compressed blocks of the given sizes in turn, with the empty one at the end."""
    out, p, k = b"", 0, 0
    while p < len(body) or p == 0:
        part = body[p : p + sizes[k % len(sizes)]]
        p, k = p + sizes[k % len(sizes)], k + 1
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        raw = z.compress(part) + z.flush()
        out += b"\x1f\x8b\x08\x04" + bytes(4) + b"\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(raw) + 25) + raw + struct.pack("<II", zlib.crc32(part), len(part))
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


class Held(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def test_any_ranges_give_each_record_once(spark, tmp_path):
    rng = random.Random(31)
    names = [f"contig{i}" for i in range(30)]
    body = b"BAM\1" + struct.pack("<i", 19) + b"@HD\tVN:1.6\nhello\n:-" + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 5000) for n in names)
    want = []
    for i in range(150):
        n = rng.choice([0, 3, 50, 51, 2000])
        ops = [n << 4] if n else []
        tags, cigar = b"NMC\x05", f"{n}M" if n else "*"
        if n == 2000:  # a CIGAR of many operations, told by its tag
            many = [1 << 4, 1 << 4 | 1] * 1000
            ops, cigar = [n << 4 | 4, 1000 << 4 | 3], "1M1I" * 1000
            tags += b"CGBI" + struct.pack(f"<i{len(many)}I", len(many), *many)
        name = f"read{i}".encode() + b"\0"
        rec = struct.pack("<iiBBHHHiiii", i % 30, i, len(name), 60, 0, len(ops), 65, n, -1, -1, 0) + name + struct.pack(f"<{len(ops)}I", *ops) + bytes(rng.choices([0x11, 0x12, 0x48, 0x84, 0xFF, 0], k=(n + 1) // 2)) + bytes(rng.choices(range(41), k=n)) + tags
        body += struct.pack("<i", len(rec)) + rec
        want.append((f"read{i}", cigar))
    for sizes in ([100, 700, 1], [60_000], [333]):
        raw = blocked(body, sizes)
        for step in (1, 97, 1000, len(raw)) if len(raw) < 40_000 and sizes == [60_000] else (401, 5000, len(raw)):
            got = [(r[0], r[5], r[11]) for a in range(0, len(raw), step) for r in sequence.bam_range(Held(raw), a, a + step)]
            assert [g[:2] for g in got] == want, (sizes, step)
            assert all(g[2] == ["NM:i:5"] for g in got)
    (tmp_path / "b.bam").write_bytes(raw)
    rows = sequence.bam(spark, str(tmp_path / "b.bam"), 4000).collect()
    assert sorted((r.qname, r.cigar) for r in rows) == sorted(want) and rows[0].tags["NM"].i == 5
    assert list(sequence.bam_range(Held(blocked(b"BAM\1" + bytes(8), [5])), 0, 10**6)) == []
