"""A sample's input, whatever its kind, as read pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.ingest import passing
from regionflow.operators.store import cut
from regionflow.sources import sequence

ALIGNED = (".bam", ".sam", ".cram")


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a pattern names, sorted, in any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def resolve(spark: SparkSession, spec: str) -> tuple[str, list]:
    """What an input is: ("paired", [(file, file), ...]) for two patterns with a comma between them, matched in sorted
    order; ("aligned", [file]) for one SAM or BAM file; else ("interleaved", [file, ...]). No files, unequal numbers,
    or several aligned files are errors."""
    sides = [expand(spark, s.strip()) for s in spec.split(",")]
    if len(sides) > 2 or not all(sides):
        raise ValueError(f"no files, or over two patterns: {spec}")
    if len(sides) == 2:
        if len(sides[0]) != len(sides[1]):
            raise ValueError(f"{len(sides[0])} files against {len(sides[1])}: {spec}")
        return "paired", list(zip(*sides))
    aligned = [f for f in sides[0] if f.lower().endswith(ALIGNED)]
    if not aligned:
        return "interleaved", sides[0]
    if len(sides[0]) > 1:
        raise ValueError(f"several files with an aligned one among them: {spec}")
    return "aligned", aligned


def _same(one: str, two: str):
    return F.when(F.col(one) == F.col(two), F.col(one)).otherwise(F.raise_error(F.concat_ws(" ", F.lit("names differ:"), one, two)))


def from_paired(spark: SparkSession, first: str, second: str) -> DataFrame:
    """Record n of both files; the shorter file ends it. The first words of the names must agree."""
    side = lambda path, k: sequence.fastq(spark, path).select("n", F.split("qname", r"\s+")[0].alias(f"name{k}"), F.col("seq").alias(f"seq{k}"), F.col("qual").alias(f"qual{k}"))
    return side(first, 1).join(side(second, 2), "n").select(_same("name1", "name2").alias("qname"), "seq1", "qual1", "seq2", "qual2")


def from_interleaved(spark: SparkSession, path: str) -> DataFrame:
    """Records 2k and 2k + 1 of a file, whose names must agree; a last one without a partner is left out."""
    odd = F.col("n") % 2
    of = lambda c, k: F.max(F.when(odd == k, F.col(c)))
    both = sequence.fastq(spark, path).groupBy(F.expr("n div 2").alias("pair")).agg(
        F.count("*").alias("c"), *[of(c, k).alias(f"{a}{k + 1}") for k in (0, 1) for c, a in (("qname", "name"), ("seq", "seq"), ("qual", "qual"))]
    )
    return both.where("c = 2").select(_same("name1", "name2").alias("qname"), "seq1", "qual1", "seq2", "qual2")


def from_aligned(spark: SparkSession, path: str) -> DataFrame:
    """Names with one passing record of each mate, supplementary ones aside; reverse records are turned back."""
    reads = sequence.records(spark, path)
    f = F.col("flag")
    turned = R.has(f, R.REVERSE)
    slim = passing(reads).select(
        "qname", R.has(f, R.READ1).alias("is1"),
        F.struct(F.when(turned, R.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(turned, F.reverse("qual")).otherwise(F.col("qual")).alias("qual")).alias("r"),
    )
    g = slim.groupBy("qname").agg(F.count("*").alias("c"), F.count_if("is1").alias("n1"), F.max(F.when(F.col("is1"), F.col("r"))).alias("a"), F.max(F.when(~F.col("is1"), F.col("r"))).alias("b"))
    return g.where("c = 2 and n1 = 1").select("qname", F.col("a.seq").alias("seq1"), F.col("a.qual").alias("qual1"), F.col("b.seq").alias("seq2"), F.col("b.qual").alias("qual2"))


def read_pairs(spark: SparkSession, spec: str) -> DataFrame:
    """qname, seq1, qual1, seq2, qual2 of an input of any kind."""
    kind, files = resolve(spark, spec)
    if kind == "paired":
        parts = [from_paired(spark, a, b) for a, b in files]
    else:
        parts = [(from_aligned if kind == "aligned" else from_interleaved)(spark, f) for f in files]
    return reduce(DataFrame.unionByName, parts)


def write_pairs(pairs: DataFrame, path: str, per_file: int = 750_000) -> None:
    """Pairs as gzipped FASTQ text, a folder per mate; pair k of a file is at place k of its twin. The pairs are kept
    first, so that both mates are written from the same rows in one order."""
    pairs = cut(pairs)
    for k in (1, 2):
        value = R.fastq(F.col("qname"), F.lit(k), F.col(f"seq{k}"), F.col(f"qual{k}"), F.lit(False)).alias("value")
        pairs.select(value).write.option("compression", "gzip").option("maxRecordsPerFile", per_file).text(f"{path}/mate={k}")
