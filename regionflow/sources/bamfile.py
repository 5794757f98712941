"""BAM files with an index beside each, a file for each range partition, and reading of a place through the index."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.sources import sequence

#: Bytes of content in a compressed block, bits of the smallest bin, the empty block at a file's end, and the
#: bytes of a reference that an entry of the linear index stands for, as bits.
CONTENT, LEAST_BIN, END, LINEAR = 65_280, 14, bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000"), 14
MANIFEST = "file string, n long, first_contig int, first_pos long, last_contig int, last_pos long"


def bin_of(lo: int, hi: int) -> int:
    """The smallest bin that holds [lo, hi) from 0: bins of 2^14, 2^17, ... bases, numbered by level."""
    hi -= 1
    for level in range(5, 0, -1):
        shift = LEAST_BIN + 3 * (5 - level)
        if lo >> shift == hi >> shift:
            return ((1 << 3 * level) - 1) // 7 + (lo >> shift)
    return 0


def bins_over(lo: int, hi: int) -> list[int]:
    """All bins that may hold what overlaps [lo, hi) from 0."""
    out = [0]
    for level in range(1, 6):
        shift, first = LEAST_BIN + 3 * (5 - level), ((1 << 3 * level) - 1) // 7
        out += range(first + (lo >> shift), first + (hi - 1 >> shift) + 1)
    return out


def encoded_tags(tags: list[str]) -> bytes:
    """Binary tags of TAG:TYPE:VALUE."""
    out = b""
    for text in tags:
        tag, kind, value = text.split(":", 2)
        out += tag.encode()
        if kind == "i":
            out += b"i" + struct.pack("<i", int(value)) if int(value) < 1 << 31 else b"I" + struct.pack("<I", int(value))
        elif kind == "f":
            out += b"f" + struct.pack("<f", float(value))
        elif kind == "B":
            sub, *numbers = value.split(",")
            code = sequence._NUMBERS[sub]
            out += b"B" + sub.encode() + struct.pack(f"<i{len(numbers)}{code}", len(numbers), *((float if sub == "f" else int)(x) for x in numbers))
        elif kind == "A":
            out += b"A" + value.encode()
        else:
            out += kind.encode() + value.encode() + b"\0"
    return out


def encoded(row: dict, ids: dict[str, int]) -> tuple[bytes, int, int, int]:
    """The binary record of a row, its reference (-1 for none) and its span [lo, hi) from 0."""
    ref, pos = ids.get(row["rname"], -1), (row["pos"] or 0) - 1
    nref = ref if row["rnext"] == "=" else ids.get(row["rnext"], -1)
    seq = "" if row["seq"] in (None, "*") else row["seq"].upper()
    ops = [(int(n), "MIDNSHP=X".index(op)) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", row["cigar"] or "*")]
    tags = encoded_tags(row["tags"] or [])
    span = sum(n for n, op in ops if op in (0, 2, 3, 7, 8))
    words = [n << 4 | op for n, op in ops]
    if len(words) > 65_535:  # as a tag, behind a stand-in
        tags, words = tags + b"CGBI" + struct.pack(f"<i{len(words)}I", len(words), *words), [len(seq) << 4 | 4, span << 4 | 3]
    lo, hi = max(pos, 0), max(pos, 0) + max(span, 1)
    name = (row["qname"] or "*").encode() + b"\0"
    codes = [sequence._BASES.find(c) if c in sequence._BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    qual = bytes(ord(c) - 33 for c in row["qual"]) if row["qual"] not in (None, "*") and len(row["qual"]) == len(seq) else b"\xff" * len(seq)
    bin_ = bin_of(lo, hi) if pos >= 0 else 4680
    head = struct.pack("<iiBBHHHiiii", ref, pos, len(name), row["mapq"] or 0, bin_, len(words), row["flag"], len(seq), nref, (row["pnext"] or 0) - 1, row["tlen"] or 0)
    body = head + name + struct.pack(f"<{len(words)}I", *words) + packed + qual + tags
    return struct.pack("<i", len(body)) + body, ref, lo, hi


class _Writer:
    """A file of compressed blocks; tell gives the place of what comes next, block << 16 | offset."""

    def __init__(self, f):
        self.f, self.at, self.held = f, 0, bytearray()

    def tell(self) -> int:
        return self.at << 16 | len(self.held)

    def write(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= CONTENT:
            self._block(bytes(self.held[:CONTENT]))
            del self.held[:CONTENT]

    def _block(self, part: bytes) -> None:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        raw = z.compress(part) + z.flush()
        block = sequence.MAGIC + bytes(4) + b"\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(raw) + 25) + raw + struct.pack("<II", zlib.crc32(part), len(part))
        self.f.write(block)
        self.at += len(block)

    def close(self) -> None:
        if self.held:
            self._block(bytes(self.held))
        self.f.write(END)


class _Index:
    """What an index tells: chunks of each bin and, for each stretch of a reference, the first record that overlaps it."""

    def __init__(self, n: int):
        self.bins: list[dict[int, list[list[int]]]] = [defaultdict(list) for _ in range(n)]
        self.linear: list[dict[int, int]] = [{} for _ in range(n)]
        self.apart = 0

    def add(self, ref: int, lo: int, hi: int, begin: int, end: int) -> None:
        if ref < 0:
            self.apart += 1
            return
        chunks = self.bins[ref][bin_of(lo, hi)]
        if chunks and chunks[-1][1] == begin:
            chunks[-1][1] = end
        else:
            chunks.append([begin, end])
        for k in range(lo >> LINEAR, (hi - 1 >> LINEAR) + 1):
            self.linear[ref].setdefault(k, begin)

    def packed(self) -> bytes:
        out = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for bins, linear in zip(self.bins, self.linear):
            out.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                out.append(struct.pack(f"<Ii{2 * len(chunks)}Q", number, len(chunks), *(x for c in chunks for x in c)))
            n, before, offsets = max(linear, default=-1) + 1, 0, []
            for k in range(n):
                before = linear.get(k, before)
                offsets.append(before)
            out.append(struct.pack(f"<i{n}Q", n, *offsets))
        return b"".join(out) + struct.pack("<Q", self.apart)


def chunks_of(index: bytes, ref: int, lo: int, hi: int) -> list[tuple[int, int]]:
    """The chunks that may hold records of a reference which overlap [lo, hi) from 0, in order, joined where they meet."""
    if index[:4] != b"BAI\1":
        raise ValueError("not an index")
    (n,), p, found, least = struct.unpack_from("<i", index, 4), 8, [], 0
    wanted = set(bins_over(lo, hi))
    for r in range(min(n, ref + 1)):
        (bins,), p = struct.unpack_from("<i", index, p), p + 4
        for _ in range(bins):
            number, count = struct.unpack_from("<Ii", index, p)
            p += 8
            if r == ref and number in wanted:
                values = struct.unpack_from(f"<{2 * count}Q", index, p)
                found += zip(values[::2], values[1::2])
            p += 16 * count
        (size,), p = struct.unpack_from("<i", index, p), p + 4
        if r == ref and size:
            (least,) = struct.unpack_from("<Q", index, p + 8 * min(lo >> LINEAR, size - 1))
        p += 8 * size
    out: list[tuple[int, int]] = []
    for begin, end in sorted(c for c in found if c[1] > least):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def write_bam(reads: DataFrame, contigs: DataFrame, path: str) -> DataFrame:
    """file, n, first_contig, first_pos, last_contig, last_pos of the BAM files that reads (SAM's eleven fields, cigar as text, and
    tags as an array of text if there are any) become below path, in order of place: one for each range partition,
    each whole by itself with its index (.bai) beside it. Reads without a place come last. contigs (contig_id from 0,
    contig, len) are the header; a name that it lacks counts as none. Files of lost attempts are in no row."""
    listed = sorted((r.contig_id, r.contig, r.len) for r in contigs.select("contig_id", "contig", "len").collect())  # the header, of each file
    names = [c for _, c, _ in listed]
    text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for _, c, n in listed)
    head = b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(names))
    head += b"".join(struct.pack("<i", len(c.encode()) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for _, c, n in listed)
    ids = {c: i for i, c in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(path)
        writer = index = None
        told, n = [], 0
        for b in batches:
            for row in b.to_pylist():
                if writer is None:
                    name = f"{place.rstrip('/')}/part-{row['_part']:05d}-{uuid.uuid4().hex[:8]}.bam"
                    store.create_dir(place, recursive=True)
                    out = store.open_output_stream(name, compression=None)
                    writer, index = _Writer(out), _Index(len(names))
                    writer.write(head)
                begin = writer.tell()
                record, ref, lo, hi = encoded(row, ids)
                writer.write(record)
                index.add(ref, lo, hi, begin, writer.tell())
                told, n = [told[0] if told else (ref, lo + 1), (ref, lo + 1)], n + 1
        if writer is not None:
            writer.close()
            out.close()
            with store.open_output_stream(name + ".bai", compression=None) as f:
                f.write(index.packed())
            uri = path.rstrip("/") + "/" + name.rsplit("/", 1)[-1]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([uri, n, *told[0], *told[1]], [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()])], [x.split()[0] for x in MANIFEST.split(", ")])

    tags = F.col("tags") if "tags" in reads.columns else F.array().cast("array<string>")
    known = F.broadcast(contigs.select(F.col("contig").alias("_c"), F.col("contig_id").alias("_id")))
    placed = reads.join(known, F.col("rname") == F.col("_c"), "left").withColumn("_last", F.col("_id").isNull())
    order = ["_last", "_id", "pos", "qname", "flag"]
    spread = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    slim = spread.select(*sequence.SAM, tags.alias("tags"), F.spark_partition_id().alias("_part"))
    return slim.mapInArrow(run, MANIFEST)


def region_records(f, index: bytes, ref: int, lo: int, hi: int) -> Iterator[tuple]:
    """The records of a file that overlap [lo, hi) from 0 of a reference, by its index: only blocks that it names are read."""
    blocks = sequence._Blocks(f, 0)
    head = iter(lambda: (blocks.next() or (0, b""))[1], b"")
    names = sequence._bam_header(sequence._Buffer(head))[0]
    for begin, end in chunks_of(index, ref, lo, hi):
        blocks.at, skip = begin >> 16, begin & 0xFFFF
        held, p = bytearray(), skip
        starts: list[tuple[int, int]] = []  # offsets in held at which blocks begin, and those blocks

        def has(n: int) -> bool:
            while len(held) < n and (got := blocks.next()) is not None:
                starts.append((len(held), got[0]))
                held.extend(got[1])
            return len(held) >= n

        while has(p + 4):
            at, block = next((o, k) for o, k in reversed(starts) if o <= p)
            if (block << 16 | p - at) >= end:
                break
            (n,) = struct.unpack_from("<i", held, p)
            has(p + 4 + n)
            row = sequence._record(bytes(held[p + 4 : p + 4 + n]), names)
            p += 4 + n
            start = row[3] - 1
            if row[2] != names[ref] or start >= hi:
                break
            if start + max(1, sum(int(k) for k, op in re.findall(r"(\d+)([MDN=X])", row[5]))) > lo:
                yield row


def read_region(spark: SparkSession, files: DataFrame, contig_id: int, lo: int, hi: int) -> DataFrame:
    """The records of files (of write_bam) that overlap lo to hi (1-based, both included) of a contig. Files that end before
    it or begin behind it are not opened."""
    first, last = F.struct("first_contig", "first_pos"), F.struct("last_contig", "last_pos")
    may = files.where((first <= F.struct(F.lit(contig_id), F.lit(hi).cast("long"))) & ((F.col("last_contig") >= contig_id) | (F.col("last_contig") < 0)) & last.isNotNull())
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("file").to_pylist():
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(place + ".bai", compression=None) as f:
                    index = f.read()
                with store.open_input_file(place) as f:
                    held = []
                    for row in region_records(f, index, contig_id, lo - 1, hi):
                        held.append(row)
                        if len(held) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], [*sequence.SAM, "tags"])
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], [*sequence.SAM, "tags"])

    out = may.select("file").repartition("file").mapInArrow(run, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags array<string>")
    return out.withColumn("tags", R.tags(F.col("tags")))
