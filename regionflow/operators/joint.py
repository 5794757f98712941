"""Genotypes of samples together, from records that tell variant sites and stretches of reference (gVCF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionflow.operators.genome import spans_over

#: The allele that stands for any that is not named, the share of genotypes with another letter, and with an indel, and
#: the likelihood (phred) of what a record does not tell.
NON_REF, HETEROZYGOUS, INDEL_HETEROZYGOUS, UNTOLD = "<NON_REF>", 1e-3, 1.25e-4, 10_000


def genotype_count(alleles: Column) -> Column:
    return F.call_function("div", alleles * (alleles + 1), F.lit(2))


def genotypes_of(n: Column) -> Column:
    """The pairs (i, j), i <= j, of n alleles in triangular order."""
    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.transform(F.sequence(F.lit(0), j), lambda i: F.struct(i.alias("i"), j.alias("j")))))


def sites(records: DataFrame) -> DataFrame:
    """contig_id, at, site_ref and site_alts of the places at which some record names an allele: the longest reference
    bases, and all alleles in order, those of shorter reference bases completed by the rest of them."""
    named = F.filter("alts", lambda a: a != NON_REF)
    some = records.where(F.size(named) > 0).select("contig_id", F.col("pos").alias("at"), "ref", named.alias("named"))
    g = some.groupBy("contig_id", "at").agg(F.max_by("ref", F.struct(F.length("ref"), "ref")).alias("site_ref"), F.collect_set(F.struct("ref", "named")).alias("xs"))
    whole = F.flatten(F.transform("xs", lambda x: F.transform(x["named"], lambda a: _completed(a, x["ref"], F.col("site_ref")))))
    return g.select("contig_id", "at", "site_ref", F.array_sort(F.array_distinct(whole)).alias("site_alts"))


def _completed(alt: Column, ref: Column, whole: Column) -> Column:
    """An allele of ref as one of the longer reference bases; `*` stays."""
    return F.when(alt.isin("*", NON_REF), alt).otherwise(F.concat(alt, F.substr(whole, F.length(ref) + 1)))


def at_sites(records: DataFrame, of: DataFrame) -> DataFrame:
    """of (sites) with each sample's record of the place: that which begins there, else the last one that covers it. The
    intervals meet by bins, so a stretch of reference costs a row a bin and not one a base."""
    iv = of.select("contig_id", F.struct("at", "site_ref", "site_alts").alias("region"), F.col("at").alias("lo"), F.col("at").alias("hi"))
    met = spans_over(records.select("sample", "contig_id", "pos", "end", "ref", "alts", "pl", "dp"), iv, F.col("end"))
    each = met.groupBy("sample", "contig_id", F.col("region.at").alias("at")).agg(
        F.max_by(F.struct("pos", "ref", "alts", "pl", "dp"), F.struct("pos", F.size(F.filter("alts", lambda a: a != NON_REF)))).alias("r"), F.first("region").alias("region")
    )
    return each.select("sample", "contig_id", "at", "region.site_ref", "region.site_alts", "r.*")


def likelihoods_at(rows: DataFrame) -> DataFrame:
    """rows with pl over the alleles of the site in triangular order, the least 0: an allele that a record does not name has
    what it says of NON_REF, and UNTOLD if it says nothing; a record of another place names none."""
    own = F.when(F.col("pos") == F.col("at"), F.transform("alts", lambda a: _completed(a, F.col("ref"), F.col("site_ref")))).otherwise(F.transform("alts", lambda a: F.when(a == NON_REF, a)))
    other = F.array_position("_own", NON_REF)  # from 1, 0 if it is not there
    place = F.transform("site_alts", lambda a: F.coalesce(F.nullif(F.array_position("_own", a), F.lit(0)), F.nullif(other, F.lit(0))).cast("int"))
    named = rows.withColumn("_own", own).withColumn("_place", F.concat(F.array(F.lit(0)), place))

    def told(g: Column) -> Column:
        a, b = F.element_at("_place", g["i"] + 1), F.element_at("_place", g["j"] + 1)
        low, high = F.least(a, b), F.greatest(a, b)
        known = F.when(a.isNotNull() & b.isNotNull(), F.get("pl", genotype_count(high).cast("int") + low))
        return F.coalesce(known, F.lit(UNTOLD))

    every = named.withColumn("_pl", F.transform(genotypes_of(F.size("site_alts") + 1), told))
    return every.withColumn("pl", F.transform("_pl", lambda x: x - F.array_min("_pl"))).drop("_own", "_place", "_pl", "pos", "ref", "alts")


def reference_phred(pl: Column, ref: Column, alts: Column) -> Column:
    """Phred that a sample has the reference's alleles alone, by its likelihoods and the shares of genotypes: alleles share
    evenly what heterozygotes, and half of that what others have. It is infinite where that share is too small for a double
    (beyond some 3,200), whose logarithm Spark takes for null."""
    n = F.size(alts)
    theta = F.when(F.exists(alts, lambda a: F.length(a) != F.length(ref)), INDEL_HETEROZYGOUS).otherwise(HETEROZYGOUS)

    def prior(g: Column) -> Column:
        return F.when(g["j"] == 0, 1 - 1.5 * theta).when(g["i"] == 0, theta / n).otherwise(theta / (n * (n + 1)))

    weighed = F.zip_with(pl, genotypes_of(n + 1), lambda p, g: prior(g) * F.pow(F.lit(10.0), -p / 10.0))
    share = F.element_at(weighed, 1) / F.aggregate(weighed, F.lit(0.0), lambda a, x: a + x)
    return F.when(share == 0, float("inf")).otherwise(-10 * F.log10(share))


def genotype(records: DataFrame) -> DataFrame:
    """contig_id, pos, ref, alts, sample, gt, gq, pl, dp, qual of records (sample, contig_id, pos, end, ref, alts, pl, dp) of one
    or more samples: a row for each sample that tells of a place where some sample has another allele. qual is the phred
    of no sample having one. Records without likelihoods, or with a null place, do not count; a sample without a record
    of a place has no row there."""
    used = records.where("pl is not null and contig_id is not null and pos is not null").withColumn("end", F.coalesce("end", F.col("pos") + F.length("ref") - 1))
    rows = likelihoods_at(at_sites(used, sites(used)))
    pairs = genotypes_of(F.size("site_alts") + 1)
    best = F.element_at(pairs, F.array_position("pl", 0).cast("int"))
    each = rows.withColumns({
        "gt": F.concat_ws("/", best["i"], best["j"]), "gq": F.least(F.lit(99), F.get(F.array_sort("pl"), F.lit(1))), "_other": best["j"] > 0, "_q": reference_phred(F.col("pl"), F.col("site_ref"), F.col("site_alts")),
    })
    whole = each.groupBy(F.col("contig_id").alias("_c"), F.col("at").alias("_p")).agg(F.sum("_q").alias("qual"), F.bool_or("_other").alias("_some")).where("_some")
    joined = each.join(whole, (F.col("contig_id") == F.col("_c")) & (F.col("at") == F.col("_p")))
    return joined.select("contig_id", F.col("at").alias("pos"), F.col("site_ref").alias("ref"), F.col("site_alts").alias("alts"), "sample", "gt", "gq", "pl", "dp", F.round("qual", 3).alias("qual"))
