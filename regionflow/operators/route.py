"""Routing of reads to regions, and coordinate order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.genome import hits_of, owned, points_in, spans_over
from regionflow.operators.ingest import numbered
from regionflow.operators.store import cut


def route(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """rec_id, dest (unmapped, qcfail, region, chri) and region (of dest region), one row per read.

    Unmapped reads go by their flag, wherever they stand or without a place, then failing ones. A name's two primaries
    stay together or go to chri both; every other read goes by its own start, to chri if several regions hold it. A
    mapped, passing read that no region holds, or without a place, is an error. A null flag is an error too. A read without a
    name has no partner."""
    f = F.col("flag")
    slim = reads.select("rec_id", "qname", F.coalesce(f, F.raise_error(F.lit("a read has no flag")).cast("int")).alias("flag"), "contig_id", "pos")
    aside = slim.where(R.has(f, R.UNMAPPED | R.QCFAIL))
    sides = aside.select("rec_id", F.when(R.has(f, R.UNMAPPED), "unmapped").otherwise("qcfail").alias("dest"), F.lit(None).cast("long").alias("region"))
    h = hits_of(slim.where(~R.has(f, R.UNMAPPED | R.QCFAIL)), iv).withColumn("prim", R.is_primary(f))
    lost = F.raise_error(F.concat_ws(" ", F.lit("no region holds"), "rec_id", "contig_id", "pos")).cast("string")
    w = Window.partitionBy(*R.name_key())
    of = lambda g, c: g(F.when(F.col("prim"), F.col(c))).over(w)
    together = (of(F.max, "n") == 1) & (of(F.min, "r") == of(F.max, "r")) & (of(F.min, "contig_id") == of(F.max, "contig_id"))
    dest = (
        F.when(F.col("n") == 0, lost)
        .when(F.col("prim") & (F.count_if(F.col("prim")).over(w) == 2), F.when(together, "region").otherwise("chri"))
        .when(F.col("n") > 1, "chri")
        .otherwise("region")
    )
    out = h.withColumn("dest", dest)
    return out.select("rec_id", "dest", F.when(F.col("dest") == "region", F.col("r")).alias("region")).unionByName(sides)


def numbered_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """df with the place of each row within its group, from 1. The rows lie in range partitions, so no group is sorted in one
    task; what a group has in the partitions before is joined, a row for each group and partition that has some of it."""
    parts = cut(df.repartitionByRange(group, *order).withColumn("_p", F.spark_partition_id()))
    inner = parts.withColumn("_k", F.row_number().over(Window.partitionBy("_p", group).orderBy(*order)))
    sizes = parts.groupBy("_p", group).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = sizes.select(F.col("_p").alias("_q"), F.col(group).alias("_g"), before.alias("_b"))
    joined = inner.join(found, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn(name, (F.col("_b") + F.col("_k")).cast("long")).drop("_p", "_k", "_q", "_g", "_b")


def coordinate_rank(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """rec_id, region and place within the region by contig, start and rec_id."""
    each = points_in(reads.select("rec_id", "contig_id", "pos"), iv)
    return numbered_within(each, "region", ["contig_id", "pos", "rec_id"], "place").select("rec_id", "region", "place")


def merged_order(reads: DataFrame, routed: DataFrame) -> DataFrame:
    """rec_id and place of the routed reads within their contig: by start, boundary reads first, then rec_id."""
    own = routed.where(F.col("dest").isin("region", "chri")).select("rec_id", F.when(F.col("dest") == "chri", 0).otherwise(1).alias("late"))
    both = own.join(reads.select("rec_id", "contig_id", "pos"), "rec_id")
    return numbered_within(both, "contig_id", ["pos", "late", "rec_id"], "place").select("rec_id", "place")


def back_to_regions(reads: DataFrame, routed: DataFrame, iv: DataFrame, end) -> DataFrame:
    """rec_id, region: the reads of each region and, of the boundary partition, all whose span (to end) overlaps it."""
    own = routed.where("dest = 'region'").select("rec_id", "region")
    boundary = reads.join(routed.where("dest = 'chri'").select("rec_id"), "rec_id", "left_semi")
    return own.unionByName(spans_over(boundary, iv, end).select("rec_id", "region").distinct())


def ordered_concat(reads: DataFrame, exact: DataFrame) -> DataFrame:
    """reads with region, each once in the region that owns its start (exact: intervals without halo), and place, its
    number in the whole by contig, start and rec_id, from 0."""
    return numbered(owned(reads, exact), ["contig_id", "pos", "rec_id"], "place")


def write_regions(reads: DataFrame, routed: DataFrame, path: str) -> None:
    """One folder per destination and region, each file in coordinate order, the files of a folder one after the other.
    Range partitions cut the large destinations up as they do any other."""
    out, order = reads.join(routed, "rec_id"), ["dest", "region", "contig_id", "pos", "rec_id"]
    out.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("dest", "region").parquet(path)


def write_sorted(reads: DataFrame, path: str) -> None:
    """Range-partitioned by place and sorted, so that the files' statistics stand in for an index."""
    reads.repartitionByRange("contig_id", "pos").sortWithinPartitions("contig_id", "pos").write.parquet(path)
