"""The command line: python -m regionflow, or spark-submit with this file."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from regionflow.plans import calls
from regionflow.sources import text
from regionflow.sources.ingest import read_pairs, resolve


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="regionflow")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("call", help="from reads to a VCF file")
    c.add_argument("reads", help="a SAM or BAM file, FASTQ with pairs in turn, or two FASTQ patterns with a comma between them")
    c.add_argument("fasta")
    c.add_argument("out", help="folder of the stages and, in it, of the VCF text")
    c.add_argument("--known", action="append", default=[], metavar="SOURCE=VCF", help="known sites, several times")
    c.add_argument("--sample", default="sample")
    c.add_argument("--least", type=int, default=calls.LEAST, help="least quality of a call, phred x 1000")
    c.add_argument("--intervals", help="a file of contig:start-end lines; calls elsewhere are left out")
    c.add_argument("--realign", action="store_true", help="align the pairs of a SAM or BAM file anew")
    i = sub.add_parser("intervals", help="interval files with 0 to 3 halos for each region")
    i.add_argument("dictionary", help="file with @SQ lines")
    i.add_argument("regions", type=int)
    i.add_argument("out")
    i.add_argument("--halo", type=int, default=1000)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Runs a command on the given session, or on the one of spark-submit."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("regionflow").getOrCreate()
    if a.command == "intervals":
        text.write_interval_files(text.sequence_dict(spark, a.dictionary), a.regions, a.out, a.halo)
        return
    known = dict(x.split("=", 1) for x in a.known)
    kind, files = resolve(spark, a.reads)
    if kind == "aligned" and not a.realign:
        vcf = calls.run(spark, files[0], a.fasta, a.out, known, a.sample, a.least, a.intervals)
    else:
        vcf = calls.run_pairs(spark, read_pairs(spark, a.reads), a.fasta, a.out, known, a.sample, a.least, a.intervals)
    vcf.write.mode("overwrite").text(f"{a.out}/vcf")


if __name__ == "__main__":
    main()
