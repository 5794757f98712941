"""Equal-length genome regions with halos, and joins of positions and spans with intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bases of a bin of the range joins.
BIN = 16_384


def with_offsets(contigs: DataFrame) -> DataFrame:
    """contigs (contig_id, contig, len) with off, the bases before each. There are as many rows as contigs."""
    before = Window.orderBy("contig_id").rowsBetween(Window.unboundedPreceding, -1)
    return contigs.withColumn("off", F.coalesce(F.sum("len").over(before), F.lit(0)).cast("long"))


def intervals(contigs: DataFrame, n_regions: int, halo: int = 0) -> DataFrame:
    """region, contig_id, contig, lo, hi (1-based, inclusive) of n_regions equal pieces of the genome, each widened by
    halo bases across contig borders and cut at the genome's ends; empty intervals are left out."""
    total = contigs.agg(F.sum("len").cast("long").alias("total")).withColumn("l", F.ceil(F.col("total") / n_regions))
    regions = contigs.sparkSession.range(n_regions).withColumnRenamed("id", "region")
    lo = F.greatest("off", F.col("region") * F.col("l") - halo)
    hi = F.least(F.col("off") + F.col("len"), (F.col("region") + 1) * F.col("l") + halo, "total")
    whole = with_offsets(contigs).crossJoin(total).crossJoin(regions)  # contigs x regions: both bounded by the plan
    return whole.where(lo < hi).select("region", "contig_id", "contig", (lo - F.col("off") + 1).alias("lo"), (hi - F.col("off")).alias("hi"))


def _binned(iv: DataFrame) -> DataFrame:
    return iv.select(F.col("contig_id").alias("iv_contig"), "region", "lo", "hi", F.explode(F.sequence(F.expr(f"lo div {BIN}"), F.expr(f"hi div {BIN}"))).alias("bin"))


def points_in(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """reads (contig_id, pos) with the region of each interval that holds the start: an equi-join on bins."""
    r = reads.withColumn("_bin", F.expr(f"pos div {BIN}"))
    on = (F.col("contig_id") == F.col("iv_contig")) & (F.col("_bin") == F.col("bin")) & F.col("pos").between(F.col("lo"), F.col("hi"))
    return r.join(_binned(iv), on).drop("_bin", "bin", "iv_contig", "lo", "hi")


def hits_of(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """reads (contig_id, pos), every one, with n, the regions that hold its start (0 for none, and for a null place), and
    r, the first of them. The intervals are gathered by bin first, so a read meets one row and is not grouped again."""
    bins = _binned(iv).groupBy("iv_contig", "bin").agg(F.collect_list(F.struct("region", "lo", "hi")).alias("_ivs"))
    on = (F.col("contig_id") == F.col("iv_contig")) & (F.expr(f"pos div {BIN}") == F.col("bin"))
    found = F.filter("_ivs", lambda x: F.col("pos").between(x["lo"], x["hi"]))
    each = reads.join(bins, on, "left").withColumn("_hit", F.coalesce(F.array_distinct(F.transform(found, lambda x: x["region"])), F.array().cast("array<bigint>")))
    return each.withColumn("n", F.size("_hit").cast("long")).withColumn("r", F.array_min("_hit")).drop("iv_contig", "bin", "_ivs", "_hit")


def spans_over(reads: DataFrame, iv: DataFrame, end: Column) -> DataFrame:
    """reads with each region that their span [pos, end] overlaps, once: the pair meets in the first bin they share."""
    r = reads.withColumn("_end", end).withColumn("_bin", F.explode(F.sequence(F.expr(f"pos div {BIN}"), F.expr(f"_end div {BIN}"))))
    on = (
        (F.col("contig_id") == F.col("iv_contig")) & (F.col("_bin") == F.col("bin")) & (F.col("pos") <= F.col("hi")) & (F.col("_end") >= F.col("lo"))
        & (F.col("bin") == F.greatest(F.expr(f"pos div {BIN}"), F.expr(f"lo div {BIN}")))
    )
    return r.join(_binned(iv), on).drop("_bin", "_end", "bin", "iv_contig", "lo", "hi")


def interval_lists(iv: DataFrame) -> DataFrame:
    """region and ivs, its intervals (contig_id, contig, lo, hi) in order. A region has one for each contig at most."""
    return iv.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("contig_id", "contig", "lo", "hi"))).alias("ivs"))


def restricted(bases: DataFrame, iv: DataFrame, place: str = "rpos") -> DataFrame:
    """Rows whose place lies in some interval, once each: the restriction of a step to the regions it is given."""
    return hits_of(bases.withColumn("pos", F.col(place)) if place != "pos" else bases, iv).where("n > 0").select(*bases.columns)


def owned(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """reads with region, that whose interval without halo holds the start: each mapped read once. A read in none is an
    error, one without a place is left out."""
    h = hits_of(reads.where("contig_id is not null and pos is not null"), iv)
    one = F.when(F.col("n") == 1, F.col("r")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("not in one region:"), "contig_id", "pos")))
    return h.withColumn("region", one).select(*reads.columns, "region")


def with_empty(regions: DataFrame, counts: DataFrame) -> DataFrame:
    """All regions with their count, 0 where there is none."""
    return regions.join(counts, "region", "left").select("region", F.coalesce("n", F.lit(0)).alias("n"))
