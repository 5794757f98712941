"""Duplicate marking by unclipped 5' ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regionflow.functions import reads as R


def ends(reads: DataFrame) -> DataFrame:
    """Passing primaries with end5 (unclipped), strand (0 forward) and score (sum of base qualities of 15 and more), and
    library where reads have it."""
    library = ["library"] if "library" in reads.columns else []
    ops = R.cigar(F.col("cigar"))
    rev = R.has(F.col("flag"), R.REVERSE)
    e = F.when(rev, F.col("pos") + R.reference_span(ops) - 1 + R.clip(ops, False)).otherwise(F.col("pos") - R.clip(ops, True))
    score = F.aggregate(F.filter(R.phred(F.col("qual")), lambda q: q >= 15), F.lit(0), lambda a, q: a + q)
    return reads.where(R.is_primary(F.col("flag"))).select("rec_id", "qname", "contig_id", e.cast("long").alias("end5"), rev.cast("int").alias("strand"), score.cast("long").alias("score"), *library)


def mark(reads: DataFrame) -> DataFrame:
    """rec_id, is_pair, duplicate. A name with exactly two passing primaries is a pair, keyed by both ends in order;
    of pairs with one key the best total score stays. Single reads are duplicates of any pair end at their place, and
    of the best single read there. Ties go to the smaller name or rec_id. Where reads have a column library, only those
    of one library are duplicates of each other. A read without a name is a single one. The best of a place is found by
    aggregation and joined by its own id, so no task gets all reads of a place."""
    w = Window.partitionBy(*R.name_key())
    found = ends(reads)
    place = [*(c for c in found.columns if c == "library"), "contig_id", "end5", "strand"]
    end = F.struct(*place)
    e = found.withColumn("k", F.count("*").over(w)).withColumn("a", F.min(end).over(w)).withColumn("b", F.max(end).over(w)).withColumn("total", F.sum("score").over(w))
    pair = F.col("k") == 2
    best = e.where(pair).groupBy("a", "b").agg(F.min(F.struct((-F.col("total")).alias("less"), "qname")).alias("x")).select(F.col("x.qname").alias("_best"))
    paired = e.where(pair).join(best, F.col("qname") == F.col("_best"), "left").select("rec_id", *place, "score", F.lit(True).alias("is_pair"), F.col("_best").isNull().alias("dup"))
    single = e.where(~pair).select("rec_id", *place, "score", F.lit(False).alias("is_pair"), F.lit(False).alias("dup"))
    both = paired.unionByName(single)
    first = both.groupBy(*place).agg(F.min(F.struct((~F.col("is_pair")).alias("single"), (-F.col("score")).alias("less"), "rec_id")).alias("x")).select(F.col("x.rec_id").alias("_first"))
    told = both.join(first, F.col("rec_id") == F.col("_first"), "left")
    return told.select("rec_id", "is_pair", F.when(F.col("is_pair"), F.col("dup")).otherwise(F.col("_first").isNull()).alias("duplicate"))


def flagged(reads: DataFrame) -> DataFrame:
    """reads with the duplicate bit set in the flag of those that mark finds, beside those that had it."""
    found = mark(reads).where("duplicate").select("rec_id", F.lit(R.DUPLICATE).alias("_bit"))
    return reads.join(found, "rec_id", "left").withColumn("flag", F.col("flag").bitwiseOR(F.coalesce("_bit", F.lit(0)))).select(*reads.columns)
