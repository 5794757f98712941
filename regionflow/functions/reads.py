"""Column functions over sequencing reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: SAM flag bits.
PAIRED, UNMAPPED, REVERSE, READ1, READ2, SECONDARY, QCFAIL, DUPLICATE, SUPPLEMENTARY = 1, 4, 16, 64, 128, 256, 512, 1024, 2048


def has(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(mask) != 0


def is_primary(flag: Column) -> Column:
    """Mapped, passing, and neither secondary nor supplementary."""
    return flag.bitwiseAND(UNMAPPED | QCFAIL | SECONDARY | SUPPLEMENTARY) == 0


def name_key() -> list[Column]:
    """What the records of a name are grouped by: those without a name are each a group of their own, by rec_id."""
    return [F.col("qname"), F.when(F.col("qname").isNull(), F.col("rec_id")).alias("_own")]


def mate(flag: Column) -> Column:
    return F.when(has(flag, READ1), 1).when(has(flag, READ2), 2)


def reverse_complement(seq: Column) -> Column:
    """Of ACGTN; another character is an error."""
    ok = F.translate(F.reverse(seq), "ACGTN", "TGCAN")
    return F.when(seq.rlike("^[ACGTN]*$"), ok).otherwise(F.raise_error(F.concat(F.lit("not a base in "), seq)))


def cigar(text: Column) -> Column:
    """array<struct<op, len>>; empty for `*`."""
    ops = F.regexp_extract_all(text, F.lit(r"(\d+)([MIDNSHP=XB])"), F.lit(2))
    sizes = F.regexp_extract_all(text, F.lit(r"(\d+)([MIDNSHP=XB])"), F.lit(1))
    return F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("op"), n.cast("int").alias("len")))


def cigar_sum(ops: Column, which: str) -> Column:
    kept = F.filter(ops, lambda x: F.instr(F.lit(which), x["op"]) > 0)
    return F.aggregate(kept, F.lit(0), lambda a, x: a + x["len"])


def reference_span(ops: Column) -> Column:
    return cigar_sum(ops, "MDN=X")


def clip(ops: Column, leading: bool) -> Column:
    """Soft and hard clipped bases at an end."""
    end = ops if leading else F.reverse(ops)
    first, second = F.get(end, F.lit(0)), F.get(end, F.lit(1))
    clipped = lambda x: F.coalesce(F.when(x["op"].isin("S", "H"), x["len"]), F.lit(0))
    return clipped(first) + F.when(first["op"] == "H", clipped(second)).otherwise(0)


def phred(qual: Column) -> Column:
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)


def cigar_text(ops: Column) -> Column:
    """The text of cigar ops; `*` for none."""
    return F.when(F.size(ops) == 0, "*").otherwise(F.array_join(F.transform(ops, lambda x: F.concat(x["len"].cast("string"), x["op"])), ""))


def tags(fields: Column) -> Column:
    """map<tag, struct<type, val, i, f, h, b>> of an array of TAG:TYPE:VALUE: val is the text, and beside it i (long) has
    the value of an i tag, f (double) of an f tag, h (binary) of an H tag and b (array of long) of a B tag, whose first
    character names the numbers' size, or d (array of double) of one of fractions. A value that is no number and an unknown
    type are errors; of tags that repeat the last counts."""
    parts = F.transform(fields, lambda f: F.split(f, ":", 3))
    # Within the array they are split once, not again for each tag that is compared with the others.
    later = lambda ps, p, i: F.exists(F.slice(ps, i + 2, F.greatest(F.size(ps), F.lit(1))), lambda q: q[0] == p[0])
    last = F.transform(F.array(parts), lambda ps: F.filter(ps, lambda p, i: ~later(ps, p, i)))[0]
    of = lambda p, kind, value: F.when(p[1] == kind, value)
    checked = F.transform(
        last,
        lambda p: F.struct(
            p[0].alias("tag"),
            F.struct(
                F.when(p[1].isin("i", "f", "H", "B", "A", "Z"), p[1]).otherwise(F.raise_error(F.concat(F.lit("tag type "), p[1]))).alias("type"), p[2].alias("val"),
                of(p, "i", p[2].cast("long")).alias("i"), of(p, "f", p[2].cast("double")).alias("f"), of(p, "H", F.unhex(p[2])).alias("h"),
                F.when((p[1] == "B") & ~p[2].startswith("f"), F.transform(F.slice(F.split(p[2], ","), 2, 1 << 30), lambda x: x.cast("long"))).alias("b"),
                F.when((p[1] == "B") & p[2].startswith("f"), F.transform(F.slice(F.split(p[2], ","), 2, 1 << 30), lambda x: x.cast("double"))).alias("d"),
            ).alias("v"),
        ),
    )
    return F.map_from_entries(checked)


def read_group(sample: str, platform: str = "ILLUMINA") -> str:
    """The @RG line of a sample's reads."""
    return f"@RG\tID:{sample}\tPL:{platform}\tSM:{sample}"


def mate_reference(rnext: Column, rname: Column) -> Column:
    return F.when(rnext == "=", rname).when(rnext == "*", F.lit(None)).otherwise(rnext)


def read_name(line: Column) -> Column:
    """struct<qname, mate> of a FASTQ name line: the mate is the name's last character where that is 1 or 2, and a suffix
    of `/` and mate is cut off."""
    bare = F.regexp_replace(line, "^@", "")
    last = F.right(bare, F.lit(1))
    return F.struct(F.regexp_replace(bare, "/[12]$", "").alias("qname"), F.when(last.isin("1", "2"), last.cast("int")).alias("mate"))


def fastq(qname: Column, which: Column, seq: Column, qual: Column, reverse: Column, parity: bool = False) -> Column:
    """A four-line record; a reverse read is turned round, its qualities too unless parity is asked for."""
    s = F.when(reverse, reverse_complement(seq)).otherwise(seq)
    q = qual if parity else F.when(reverse, F.reverse(qual)).otherwise(qual)
    return F.concat_ws("\n", F.concat(F.lit("@"), qname, F.lit("/"), which.cast("string")), s, F.lit("+"), q)


def region_name(region: Column, n_regions: int) -> Column:
    return F.concat(F.lit("region_"), F.lpad(region.cast("string"), len(str(n_regions)), "0"))


def interval_text(contig: Column, lo: Column, hi: Column) -> Column:
    return F.concat(contig, F.lit(":"), lo.cast("string"), F.lit("-"), hi.cast("string"))
