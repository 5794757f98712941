import io
import random
import struct

from pyspark.sql import functions as F

from regionflow.operators.store import cut
from regionflow.sources import bamfile, sequence


class Counted(io.BytesIO):
    """A file that tells how many bytes were read of it."""

    def __init__(self, data):
        super().__init__(data)
        self.n = 0

    def size(self):
        return len(self.getbuffer())

    def read(self, n=-1):
        out = super().read(n)
        self.n += len(out)
        return out


def test_bins_hold_and_find_each_other():
    rng = random.Random(61)
    for _ in range(2000):
        lo = rng.randrange(1 << 29)
        hi = min(1 << 29, lo + rng.choice([1, 100, 20_000, 1 << 20, 1 << 27]))
        b = bamfile.bin_of(lo, hi)
        x = rng.randrange(lo, hi)
        assert b in bamfile.bins_over(x, x + 1) and b in bamfile.bins_over(max(0, x - 50), x + 1)
    assert (bamfile.bin_of(0, 1), bamfile.bin_of(1 << 14, (1 << 14) + 5), bamfile.bin_of(0, 1 << 29), len(bamfile.bins_over(0, 1 << 29))) == (4681, 4682, 0, 37449)


def test_written_files_are_read_by_place(spark, tmp_path):
    rng = random.Random(62)
    contigs = spark.createDataFrame([(0, "one", 3_000_000), (1, "two", 90_000)], "contig_id int, contig string, len long")
    rows = []
    for i in range(4000):
        c, at = rng.choice([("one", rng.randint(1, 2_900_000)), ("one", rng.randint(500_000, 510_000)), ("two", rng.randint(1, 80_000)), ("*", 0)])
        cigar = "*" if c == "*" else rng.choice(["50M", "5S20M3D25M", "20M9000N30M"])
        rows.append((f"r{i}", 4 if c == "*" else 0, c, at, 30, cigar, "=" if c == "two" else "*", at if c == "two" else 0, -7, "".join(rng.choices("ACGTN", k=50)), "".join(chr(33 + rng.randint(2, 40)) for _ in range(50)), [f"NM:i:{i}", "RG:Z:g1", "XF:f:0.5", "XB:B:s,-1,300"]))
    frame = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = cut(bamfile.write_bam(frame, contigs, f"file://{tmp_path}/out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.count() > 2 and files.agg(F.sum("n")).first()[0] == 4000
    back = {r.qname: r for r in sequence.bam(spark, f"{tmp_path}/out/*.bam", 20_000).collect()}
    for q, *rest in rows:
        r = back[q]
        assert [r.flag, r.rname or "*", r.pos, r.mapq, r.cigar, r.rnext, r.pnext, r.tlen, r.seq, r.qual] == rest[:10], q
        assert (r.tags["NM"].i, r.tags["RG"].val, r.tags["XF"].f, r.tags["XB"].b) == (int(q[1:]), "g1", 0.5, [-1, 300])

    def over(c, lo, hi):
        span = {"50M": 50, "5S20M3D25M": 48, "20M9000N30M": 9050}
        return {r[0] for r in rows if r[2] == c and r[3] <= hi and r[3] + span[r[5]] - 1 >= lo}

    for contig, lo, hi in ((0, 505_000, 505_100), (0, 1, 3_000_000), (1, 40_000, 40_001), (0, 2_999_000, 3_000_000), (1, 16_384, 16_385), (0, 1_234_567, 1_240_000)):
        got = [r.qname for r in bamfile.read_region(spark, files, contig, lo, hi).collect()]
        assert len(got) == len(set(got)) and set(got) == over(["one", "two"][contig], lo, hi)


def test_only_named_blocks_are_read():
    rng = random.Random(63)
    writer, index = bamfile._Writer(out := io.BytesIO()), bamfile._Index(1)
    writer.write(b"BAM\1" + struct.pack("<iii", 0, 1, 4) + b"one\0" + struct.pack("<i", 10_000_000))
    for i in range(20_000):
        row = {"qname": f"r{i}", "flag": 0, "rname": "one", "pos": 1 + 400 * i, "mapq": 9, "cigar": "100M", "rnext": "*", "pnext": 0, "tlen": 0, "seq": "".join(rng.choices("ACGT", k=100)), "qual": "I" * 100, "tags": []}
        begin = writer.tell()
        record, ref, lo, hi = bamfile.encoded(row, {"one": 0})
        writer.write(record)
        index.add(ref, lo, hi, begin, writer.tell())
    writer.close()
    f = Counted(out.getvalue())
    got = [r[0] for r in bamfile.region_records(f, index.packed(), 0, 4_000_000, 4_002_000)]
    assert got == [f"r{i}" for i in range(10_000, 10_005)]
    assert f.n < 400_000 < f.size() / 2
