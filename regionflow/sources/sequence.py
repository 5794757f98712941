"""FASTQ, FASTA, SAM, BAM and VCF."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.ingest import numbered, unpaired, with_contigs
from regionflow.operators.store import cut

SAM = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """n (record), qname, mate, seq, qual of a file, gzipped or not. Lines are numbered by file and place, so the
    result does not depend on partitions; a record without `@` and `+` is an error. An empty line where a name should be
    ends the file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i"))
    at = numbered(lines, ["f", "s", "i"], "line_no")
    end = at.where("line_no % 4 = 0 and trim(value) = ''").agg(F.min("line_no").alias("_end"))  # a row
    at = at.crossJoin(end).where("_end is null or line_no < _end")
    rec = at.groupBy(F.expr("line_no div 4").alias("n")).agg(*[F.max(F.when(F.col("line_no") % 4 == k, F.col("value"))).alias(c) for k, c in enumerate(("name", "seq", "plus", "qual"))])
    ok = F.col("name").startswith("@") & F.col("plus").startswith("+")
    checked = F.when(ok, F.col("name")).otherwise(F.raise_error(F.concat(F.lit("not a FASTQ record: "), "name")))
    return rec.select("n", R.read_name(checked).alias("x"), "seq", "qual").select("n", "x.qname", "x.mate", "seq", "qual")


def write_fastq(reads: DataFrame, path: str, per_file: int = 750_000, parity: bool = False) -> None:
    """reads (qname, flag, seq, qual) as gzipped text, a folder per mate."""
    f = F.col("flag")
    out = reads.select(R.mate(f).alias("mate"), R.fastq(F.col("qname"), R.mate(f), F.col("seq"), F.col("qual"), R.has(f, R.REVERSE), parity).alias("value"))
    out.write.option("compression", "gzip").option("maxRecordsPerFile", per_file).partitionBy("mate").text(path)


def write_unpaired(reads: DataFrame, path: str) -> None:
    """The passing records without a partner as gzipped FASTQ text."""
    write_fastq(unpaired(reads), path)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """contig_id (file order), contig (the first word of the name), line (from 0), width, seq (upper case) of the lines of
    a FASTA file. All lines of a contig but the last must be as wide as its first; another is an error."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i"))
    at = numbered(lines.where("trim(value) <> ''"), ["f", "s", "i"], "at").select("at", F.trim("value").alias("value"))
    heads = numbered(at.where("value like '>%'"), ["at"], "contig_id").select(F.col("contig_id").cast("int").alias("contig_id"), "at", F.regexp_extract("value", r"^>(\S*)", 1).alias("contig"))
    after = Window.orderBy("at")  # a row per contig
    spans = heads.select("contig_id", "contig", (F.col("at") + 1).alias("lo"), F.coalesce(F.lead("at").over(after) - 1, F.lit(1 << 60)).alias("hi"))
    last = at.agg(F.max("at").alias("last"))  # a row
    spans = spans.crossJoin(last).select("contig_id", "contig", "lo", F.least("hi", "last").alias("hi")).where("lo <= hi")
    spans = spans.join(at.select(F.col("at").alias("lo"), F.length("value").alias("width")), "lo")
    cells = spans.withColumn("bin", F.explode(F.sequence(F.expr("lo div 65536"), F.expr("hi div 65536"))))
    rows = at.withColumn("bin", F.expr("at div 65536")).join(cells, "bin").where("at between lo and hi")
    fits = (F.length("value") == F.col("width")) | ((F.col("at") == F.col("hi")) & (F.length("value") <= F.col("width")))
    seq = F.when(fits, F.upper("value")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("uneven lines in"), "contig")))
    return rows.select("contig_id", "contig", (F.col("at") - F.col("lo")).alias("line"), "width", seq.alias("seq"))


def contigs_of(reference: DataFrame) -> DataFrame:
    """contig_id, contig, len of a reference (of fasta)."""
    return reference.groupBy("contig_id", "contig").agg(F.sum(F.length("seq")).cast("long").alias("len"))


def with_reference(bases: DataFrame, reference: DataFrame) -> DataFrame:
    """bases (contig_id, rpos) with ref_base, joined by contig and line; bases beyond the reference, and those over an N
    of it, are left out. Widths are a row per contig."""
    widths = F.broadcast(reference.groupBy(F.col("contig_id").alias("_c")).agg(F.first("width").alias("_w")))
    at = bases.join(widths, F.col("contig_id") == F.col("_c")).withColumn("_line", F.expr("(rpos - 1) div _w"))
    lines = reference.select(F.col("contig_id").alias("_rc"), F.col("line").alias("_rl"), F.col("seq").alias("_seq"))
    joined = at.join(lines, (F.col("_c") == F.col("_rc")) & (F.col("_line") == F.col("_rl")))
    ref = F.substring("_seq", ((F.col("rpos") - 1) % F.col("_w") + 1).cast("int"), F.lit(1))
    return joined.withColumn("ref_base", ref).where("ref_base in ('A', 'C', 'G', 'T')").drop("_c", "_w", "_line", "_rc", "_rl", "_seq")


def parse_sam(lines: DataFrame) -> DataFrame:
    """Records of SAM text lines (value): eleven fields, cigar as ops, mate reference resolved, tags typed, further
    columns of lines kept. Works on static and streaming lines alike; fewer fields are an error."""
    p, kept = F.split("value", "\t"), [c for c in lines.columns if c != "value"]
    body = lines.where(~F.col("value").startswith("@")).select(
        F.when(F.size(p) >= 11, p).otherwise(F.raise_error(F.concat(F.lit("not a SAM record: "), "value"))).alias("p"), *kept
    )
    col = {c: F.col("p")[i] for i, c in enumerate(SAM)}
    num = {c: col[c].cast("long") for c in ("pos", "pnext", "tlen")} | {c: col[c].cast("int") for c in ("flag", "mapq")}
    rname = F.when(col["rname"] != "*", col["rname"])
    return body.select(
        col["qname"].alias("qname"), num["flag"].alias("flag"), rname.alias("rname"), num["pos"].alias("pos"), num["mapq"].alias("mapq"),
        R.cigar(col["cigar"]).alias("cigar"), R.mate_reference(col["rnext"], rname).alias("rnext"), num["pnext"].alias("pnext"), num["tlen"].alias("tlen"),
        col["seq"].alias("seq"), col["qual"].alias("qual"), R.tags(F.slice("p", 12, F.greatest(F.size("p") - 11, F.lit(0)))).alias("tags"), *kept,
    )


def sam_header(spark: SparkSession, path: str) -> DataFrame:
    """kind (HD, SQ, RG, PG, CO), n (their order in the file) and fields (map) of the header lines. HD lines become one row,
    of whose keys the last value counts; a comment's text is the field `text`."""
    lines = spark.read.text(path).where("value like '@%'").select("value", F.monotonically_increasing_id().alias("n"))
    kind, rest = F.substr(F.col("value"), F.lit(2), F.lit(2)), F.filter(F.split("value", "\t"), lambda x: x.contains(":"))
    pairs = F.transform(rest, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.regexp_replace(x, "^[^:]*:", "").alias("value")))
    text = F.array(F.struct(F.lit("text").alias("key"), F.regexp_replace("value", "^@CO\t", "").alias("value")))
    rows = lines.select("n", kind.alias("kind"), F.when(kind == "CO", text).otherwise(pairs).alias("fields"))
    one = rows.where("kind = 'HD'").select("n", F.explode("fields").alias("x")).groupBy("x.key").agg(F.max_by("x.value", "n").alias("value"), F.min("n").alias("n"))
    head = one.groupBy().agg(F.min("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("fields")).where("n is not null")
    rest = rows.where("kind <> 'HD'").select("kind", "n", F.map_from_entries("fields").alias("fields"))
    return head.select(F.lit("HD").alias("kind"), "n", "fields").unionByName(rest)


def sam(spark: SparkSession, path: str) -> DataFrame:
    return parse_sam(spark.read.text(path))


def as_reads(records: DataFrame, contigs: DataFrame, sample: str = "sample") -> DataFrame:
    """What the operators work on, of SAM or BAM records: rec_id (unique, text), qname, flag, contig_id, pos, mapq, cigar
    (text), seq, qual, rg (the RG tag or the sample). Records are kept first, so that ids stay as they are."""
    text = R.cigar_text(F.col("cigar")) if dict(records.dtypes)["cigar"].startswith("array") else F.col("cigar")
    rg = F.coalesce(F.try_element_at("tags", F.lit("RG"))["val"], F.lit(sample)) if "tags" in records.columns else F.lit(sample)
    named = with_contigs(records.withColumn("rname", F.when(F.col("rname") != "*", F.col("rname"))), contigs)
    slim = named.select(
        F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0").alias("rec_id"), "qname", "flag", "contig_id", F.when(F.col("contig_id").isNotNull(), F.col("pos")).alias("pos"),
        "mapq", text.alias("cigar"), "seq", "qual", rg.alias("rg"),
    )
    return cut(slim)


def sam_lines(reads: DataFrame) -> DataFrame:
    """value: SAM text of reads with the eleven fields (cigar as text)."""
    return reads.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in SAM]).alias("value"))


def _pieces(f) -> Iterator[bytes]:
    """The content of a gzip file of many members, such as a blocked one, piece by piece."""
    d = zlib.decompressobj(31)
    while held := f.read(1 << 18):
        while held:
            yield d.decompress(held)
            held = d.unused_data
            if d.eof:
                d = zlib.decompressobj(31)
            else:
                break


class _Buffer:
    """Bytes that arrive in pieces, taken from the front."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def take(self, n: int) -> bytes:
        """The next n bytes; fewer at the end."""
        if len(self.held) - self.at < n:
            parts, size = [self.held[self.at :]], len(self.held) - self.at
            for piece in self.pieces:
                parts.append(piece)
                size += len(piece)
                if size >= max(n, 1 << 20):
                    break
            self.held, self.at = b"".join(parts), 0
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out


_BASES = "=ACMGRSVTWYHKDBN"
_TWO = [a + b for a in _BASES for b in _BASES]
#: The numbers of binary tags by their type.
_NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _binary_tags(b: bytes) -> list[str]:
    """TAG:TYPE:VALUE of the tags at a record's end."""
    out, p = [], 0
    while p < len(b):
        tag, kind, p = b[p : p + 2].decode(), chr(b[p + 2]), p + 3
        if kind in "ZH":
            end = b.index(0, p)
            value, p = b[p:end].decode(), end + 1
        elif kind == "A":
            value, p = chr(b[p]), p + 1
        elif kind == "B":
            sub, n = chr(b[p]), struct.unpack_from("<i", b, p + 1)[0]
            numbers = struct.unpack_from(f"<{n}{_NUMBERS[sub]}", b, p + 5)
            value, p = ",".join([sub, *map(str, numbers)]), p + 5 + n * struct.calcsize(_NUMBERS[sub])
        else:
            (number,) = struct.unpack_from("<" + _NUMBERS[kind], b, p)
            value, p = str(number), p + struct.calcsize(_NUMBERS[kind])
            kind = "f" if kind == "f" else "i"
        out.append(f"{tag}:{kind}:{value}")
    return out


def _long_cigar(cigar: str, l_seq: int, tags: list[str]) -> tuple[str, list[str]]:
    """The CIGAR of the CG tag, and the other tags, where a record's own is a stand-in for one of too many operations."""
    held = next((t for t in tags if t.startswith("CG:B:")), None)
    if held is None or not re.fullmatch(rf"{l_seq}S\d+N", cigar):
        return cigar, tags
    return "".join(f"{int(x) >> 4}{'MIDNSHP=X'[int(x) & 15]}" for x in held.split(",")[1:]), [t for t in tags if t is not held]


def _record(r: bytes, names: list[str]) -> tuple:
    """SAM's eleven fields and the tags of a binary record."""
    name = lambda i: "*" if i < 0 else names[i]
    ref, pos, l_name, mapq, _, n_ops, flag, l_seq, nref, npos, tlen = struct.unpack_from("<iiBBHHHiiii", r, 0)
    p = 32 + l_name
    qname, ops = r[32 : p - 1].decode(), struct.unpack_from(f"<{n_ops}I", r, p)
    p += 4 * n_ops
    packed, p = r[p : p + (l_seq + 1) // 2], p + (l_seq + 1) // 2
    seq, q = "".join(map(_TWO.__getitem__, packed))[:l_seq], r[p : p + l_seq]
    qual = "*" if not l_seq or q[0] == 255 else bytes(x + 33 for x in q).decode()
    cigar, tags = _long_cigar("".join(f"{x >> 4}{'MIDNSHP=X'[x & 15]}" for x in ops) or "*", l_seq, _binary_tags(r[p + l_seq :]))
    rnext = "=" if nref == ref and ref >= 0 else name(nref)
    return qname, flag, name(ref), pos + 1, mapq, cigar, rnext, npos + 1, tlen, seq or "*", qual, tags


def _bam_header(b: _Buffer) -> tuple[list[str], list[int], int]:
    """Names and lengths of the references, and how many bytes the header takes."""
    number = lambda: struct.unpack("<i", b.take(4))[0]
    if b.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = number()
    b.take(text)
    names, lengths, size = [], [], 12 + text
    for _ in range(number()):
        n = number()
        names.append(b.take(n)[:-1].decode())
        lengths.append(number())
        size += 8 + n
    return names, lengths, size


def decode_bam(f) -> Iterator[tuple]:
    """SAM's eleven fields and the tags of each record of a BAM file; a record at a time is held."""
    b = _Buffer(_pieces(f))
    names = _bam_header(b)[0]
    while size := b.take(4):
        yield _record(b.take(struct.unpack("<i", size)[0]), names)


#: Bytes of a range of a BAM file, and records that must follow each other for a place to count as a record's start.
RANGE, CHAIN = 32 << 20, 4
#: Bytes of a compressed block at most, and what one begins with.
BLOCK, MAGIC = 1 << 16, b"\x1f\x8b\x08\x04"


def _block_size(head: bytes) -> int | None:
    """Bytes of the compressed block that begins with head, None if none does: its extra field says how many."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    (extra,) = struct.unpack_from("<H", head, 10)
    p, end = 12, 12 + extra
    while p + 4 <= min(end, len(head)):
        (n,) = struct.unpack_from("<H", head, p + 2)
        if head[p : p + 2] == b"BC" and n == 2 and p + 6 <= len(head):
            return struct.unpack_from("<H", head, p + 4)[0] + 1
        p += 4 + n
    return None


class _Blocks:
    """The compressed blocks of a file from the first one that begins at start or later."""

    def __init__(self, f, start: int):
        self.f, self.size = f, f.size()
        self.at = self._first(start)

    def _head(self, at: int) -> bytes:
        self.f.seek(at)
        return self.f.read(min(512, self.size - at))

    def _whole(self, at: int) -> bytes | None:
        """The content of the block at at; None if there is none that can be decoded."""
        n = _block_size(self._head(at))
        if n is None or at + n > self.size:
            return None
        self.f.seek(at)
        raw = self.f.read(n)
        d = zlib.decompressobj(31)
        try:
            out = d.decompress(raw)
        except zlib.error:
            return None
        return out if d.eof and not d.unused_data else None

    def _first(self, start: int) -> int:
        if start == 0:
            return 0
        at = start
        while at < self.size:
            self.f.seek(at)
            window = self.f.read(min(2 * BLOCK, self.size - at))
            p = window.find(MAGIC)
            while p >= 0:
                if self._whole(at + p) is not None:  # its checksum holds, so it is one
                    return at + p
                p = window.find(MAGIC, p + 1)
            at += max(1, len(window) - 3)
        return self.size

    def next(self) -> tuple[int, bytes] | None:
        """Where the next block begins, and its content; None at the end."""
        if self.at >= self.size:
            return None
        at, data = self.at, self._whole(self.at)
        if data is None:
            raise ValueError(f"a broken block at {at}")
        self.at += _block_size(self._head(at))
        return at, data


def _plausible(b: bytes, p: int, lengths: list[int]) -> int | None:
    """The end of the record that may begin at p of b, None if none does. b must hold the first 36 bytes."""
    size, ref, pos, l_name, _, _, n_ops, _, l_seq, nref, npos, _ = struct.unpack_from("<iiiBBHHHiiii", b, p)
    fits = l_name >= 1 and l_seq >= 0 and 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq <= size
    placed = lambda r, x: -1 <= r < len(lengths) and -1 <= x and (r < 0 or x <= lengths[r])
    if not fits or not placed(ref, pos) or not placed(nref, npos):
        return None
    name = b[p + 36 : p + 36 + l_name]
    if len(name) == l_name and (name[-1] != 0 or not all(33 <= c <= 126 for c in name[:-1])):
        return None
    ops = b[p + 36 + l_name : p + 36 + l_name + 4 * n_ops]
    if any(x & 15 > 8 for x in ops[::4]):
        return None
    return p + 4 + size


def bam_range(f, start: int, stop: int) -> Iterator[tuple]:
    """The records that begin in the blocks which begin at start or later and before stop. Ranges that meet end to end give
    each record once, however they are cut. The first record of a range is the first place from which CHAIN records follow
    each other, or all up to the file's end. A file that is not made of blocks is its first range's."""
    whole = _Blocks.__new__(_Blocks)
    whole.f, whole.size, whole.at = f, f.size(), 0
    if _block_size(whole._head(0)) is None:
        if start == 0:
            f.seek(0)
            yield from decode_bam(f)
        return
    ends: list[tuple[int, int]] = []  # where blocks begin, and the bytes up to their end

    def content() -> Iterator[bytes]:
        total = 0
        while (got := whole.next()) is not None:
            total += len(got[1])
            ends.append((got[0], total))
            yield got[1]

    names, lengths, size = _bam_header(_Buffer(content()))
    at_block = next((at for at, end in ends if end > size), None)  # the block of the first record, if it is read yet
    if at_block is None:
        while at_block is None and (got := whole.next()) is not None:
            ends.append((got[0], ends[-1][1] + len(got[1])))
            at_block = got[0] if ends[-1][1] > size else None
        if at_block is None:
            return
    skip = size - max((end for at, end in ends if at < at_block), default=0)
    blocks = _Blocks(f, start)
    if blocks.at < at_block:
        blocks.at = at_block
    if blocks.at >= stop:
        return
    known = blocks.at == at_block
    held, own, p = bytearray(), 0, skip if known else 0
    done = False

    def more() -> bool:
        nonlocal own, done
        got = None if done else blocks.next()
        if got is None:
            done = True
            return False
        held.extend(got[1])
        own += len(got[1]) if got[0] < stop else 0
        return True

    def has(n: int) -> bool:
        while len(held) < n and more():
            pass
        return len(held) >= n

    def chained(p: int) -> bool:
        for _ in range(CHAIN):
            if not has(p + 36):
                return len(held) == p
            end = _plausible(held, p, lengths)
            if end is None:
                return False
            has(min(end, p + 36 + 255 + 4 * 65535))
            if _plausible(held, p, lengths) is None:  # now with its name and CIGAR
                return False
            p = end
        return True

    def owned(p: int) -> bool:
        while p >= own and blocks.at < stop and more():
            pass
        return p < own

    while not known and owned(p):
        known = has(p + 36) and chained(p)
        p += not known
    while owned(p) and has(p + 4):
        (n,) = struct.unpack_from("<i", held, p)
        if not has(p + 4 + n):
            raise ValueError("a record ends before its length")
        yield _record(bytes(held[p + 4 : p + 4 + n]), names)
        p += 4 + n
        if p > 4 * BLOCK:
            gone = min(p, own)
            del held[:gone]
            p, own = p - gone, own - gone


def bam(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """The eleven fields and typed tags of BAM files, ranges of size bytes in tasks of their own, each read as a stream: a
    task holds some blocks and some thousand records, however large its file."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    ranges = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))))
    spread = ranges.withColumn("stop", F.col("start") + size).repartition("path", "start")
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start, stop in zip(*(b.column(c).to_pylist() for c in ("path", "start", "stop"))):
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_file(place) as f:
                    rows = bam_range(f, start, stop)
                    while held := list(islice(rows, 5000)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], [*SAM, "tags"])

    out = spread.drop("length").mapInArrow(run, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>")
    return out.withColumn("tags", R.tags(F.col("tags")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a SAM or BAM file, by its ending in either case; another, CRAM too, is an error."""
    kind = path.lower().rsplit(".", 1)[-1]
    if kind not in ("sam", "bam"):
        raise ValueError(f"{kind.upper()} is not read: {path}")
    return (sam if kind == "sam" else bam)(spark, path)


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """contig, pos, id, ref, alt (array), qual, filter (array), info (map)."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(p.alias("p"))
    value = lambda i: F.when(F.col("p")[i] != ".", F.col("p")[i])
    return rows.select(
        F.col("p")[0].alias("contig"), F.col("p")[1].cast("long").alias("pos"), value(2).alias("id"), F.col("p")[3].alias("ref"), F.split(F.col("p")[4], ",").alias("alt"),
        value(5).cast("double").alias("qual"), F.split(value(6), ";").alias("filter"), F.str_to_map(value(7), F.lit(";"), F.lit("=")).alias("info"),
    )


def gvcf(spark: SparkSession, path: str) -> DataFrame:
    """sample, contig, pos, end, ref, alts (array), gt, dp, gq, pl of VCF files with a sample column, stretches of reference (END
    in the info) too. The sample is named by each file's own header; a file without one is an error. Missing fields are null."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    heads = lines.where("value like '#CHROM%'").select(F.col("file").alias("h_file"), F.get(F.split("value", "\t"), F.lit(9)).alias("sample"))  # a row a file
    body = lines.where(~F.col("value").startswith("#")).join(heads, F.col("file") == F.col("h_file"), "left")
    p = F.split("value", "\t")
    rows = body.select(F.coalesce("sample", F.raise_error(F.concat(F.lit("no sample in "), "file")).cast("string")).alias("sample"), p.alias("p"))
    told = F.map_from_arrays(F.slice(F.split(F.get("p", F.lit(8)), ":"), F.lit(1), F.size(F.split(F.get("p", F.lit(9)), ":"))), F.split(F.get("p", F.lit(9)), ":"))
    field = lambda k: F.when(F.try_element_at("told", F.lit(k)) != ".", F.try_element_at("told", F.lit(k)))
    stop = F.try_element_at(F.str_to_map(F.get("p", F.lit(7)), F.lit(";"), F.lit("=")), F.lit("END"))
    pos = F.get("p", F.lit(1)).cast("long")
    return rows.withColumn("told", told).select(
        "sample", F.get("p", F.lit(0)).alias("contig"), pos.alias("pos"), F.coalesce(stop.cast("long"), pos + F.length(F.get("p", F.lit(3))) - 1).alias("end"), F.get("p", F.lit(3)).alias("ref"),
        F.filter(F.split(F.get("p", F.lit(4)), ","), lambda a: a != ".").alias("alts"), field("GT").alias("gt"), field("DP").cast("long").alias("dp"), field("GQ").cast("int").alias("gq"), F.split(field("PL"), ",").cast("array<int>").alias("pl"),
    )


def known_sites(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The sites of several VCF files (source: path), as vcf gives them, with source. An empty dict is an error."""
    return reduce(DataFrame.unionByName, [vcf(spark, path).withColumn("source", F.lit(source)) for source, path in paths.items()])


def vcf_line(calls: DataFrame) -> Column:
    """The VCF text of a row of calls (contig, pos, id, ref, alt (array), qual, filter (array), and info (map) and sample, the
    text of GT:..., if there are such columns; format names the sample's fields, GT if it is not there)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    info = F.lit(".")
    if "info" in calls.columns:
        listed = F.array_join(F.transform(F.array_sort(F.map_keys("info")), lambda k: F.concat_ws("=", k, F.try_element_at("info", k))), ";")
        info = F.when(F.size("info") > 0, listed).otherwise(F.lit("."))
    fields = [F.col("contig"), text("pos"), text("id"), F.col("ref"), F.coalesce(F.array_join("alt", ","), F.lit(".")), text("qual"), F.coalesce(F.array_join("filter", ";"), F.lit(".")), info]
    if "sample" in calls.columns:
        fields += [F.col("format") if "format" in calls.columns else F.lit("GT"), F.col("sample")]
    return F.concat_ws("\t", *fields)


def vcf_lines(calls: DataFrame) -> DataFrame:
    """value: the VCF text of calls, without a header."""
    return calls.select(vcf_line(calls).alias("value"))


#: The header lines that describe what calls carry.
VCF_HEADER = [
    "##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Depth of each allele">', '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">',
]


def vcf_text(calls: DataFrame, contigs: DataFrame, sample: str | None = None) -> DataFrame:
    """value: a whole VCF file in order, header first: the dictionary's contigs, then calls (contig_id, pos and what
    vcf_line takes) by place. Range partitions keep the order, so files that are written from it follow each other."""
    spark = calls.sparkSession
    names = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"] + (["FORMAT", sample] if sample else [])
    schema = "_part int, _a long, _b long, value string"
    head = spark.createDataFrame([(0, i, 0, x) for i, x in enumerate(VCF_HEADER)] + [(2, 0, 0, "\t".join(names))], schema)
    listed = contigs.select(F.lit(1).alias("_part"), F.col("contig_id").cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"), F.format_string("##contig=<ID=%s,length=%d>", "contig", "len").alias("value"))
    keyed = calls.select("*", F.lit(3).alias("_part"), F.col("contig_id").cast("long").alias("_a"), F.col("pos").cast("long").alias("_b"))
    whole = head.unionByName(listed).unionByName(keyed.select("_part", "_a", "_b", vcf_line(calls).alias("value")))
    return whole.repartitionByRange("_part", "_a", "_b").sortWithinPartitions("_part", "_a", "_b").select("value")
