"""Pileup, diploid genotype likelihoods in integers (10,000 x -log10), reference bands and genotypes."""

from __future__ import annotations

from math import log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.active import depths
from regionflow.operators.ingest import numbered

MIN_BASE_QUALITY, HET = 17, 3010
SITE = ["contig_id", "rpos", "ref_base"]


def pileup(bases: DataFrame) -> DataFrame:
    """depth and sum_bq of each call at each site, of bases of MIN_BASE_QUALITY and more."""
    return bases.where(F.col("bq") >= MIN_BASE_QUALITY).groupBy(*SITE, "base_call").agg(F.count("*").alias("depth"), F.sum("bq").cast("long").alias("sum_bq"))


def alleles(bases: DataFrame) -> DataFrame:
    """dp, n_ref and n_alt of each site, of bases of MIN_BASE_QUALITY and more."""
    ok = bases.where(F.col("bq") >= MIN_BASE_QUALITY)
    ref = F.col("base_call") == F.col("ref_base")
    return ok.groupBy(*SITE).agg(F.count("*").alias("dp"), F.count_if(ref).alias("n_ref"), F.count_if(~ref).alias("n_alt"))


def likelihoods(bases: DataFrame) -> DataFrame:
    """rr, ra, aa: a matching base costs -log10(1 - e), another -log10(e / 3), either one 0.301 in a heterozygote."""
    return _likelihoods(_by_quality(bases))


def _by_quality(bases: DataFrame, *more: Column) -> DataFrame:
    """How many bases (_n, and more aggregates) of MIN_BASE_QUALITY and more a site has of a quality, and with more of a strand, that
    are reference (_ref) or not: costs are logarithms, taken of such a row and not of each base."""
    strand = [R.has(F.col("flag"), R.REVERSE).alias("_rev")] if more else []
    return bases.where(F.col("bq") >= MIN_BASE_QUALITY).groupBy(*SITE, (F.col("base_call") == F.col("ref_base")).alias("_ref"), *strand, "bq").agg(F.count("*").alias("_n"), *more)


def _likelihoods(each: DataFrame, *more: Column) -> DataFrame:
    match, other = _costs()
    ref, n = F.col("_ref"), F.col("_n")
    g = each.groupBy(*SITE).agg(
        F.sum(n).alias("dp"), F.sum(F.when(~ref, n).otherwise(0)).alias("n_alt"), F.sum(n * F.when(ref, match).otherwise(other)).alias("rr"), F.sum(n * F.when(ref, other).otherwise(match)).alias("aa"), *more
    )
    return g.withColumn("ra", HET * F.col("dp"))


def _gt(best: Column) -> Column:
    return F.when(F.col("rr") == best, "0/0").when(F.col("ra") == best, "0/1").otherwise("1/1")


def genotypes(lik: DataFrame, *kept: str) -> DataFrame:
    """gt, qual (phred x 1000 that the site is not reference) and gq (x 1000, to the next genotype)."""
    best = F.least("rr", "ra", "aa")
    second = F.sort_array(F.array("rr", "ra", "aa"))[1]
    return lik.select(*SITE, "dp", "n_alt", _gt(best).alias("gt"), (F.col("rr") - best).alias("qual"), (second - best).alias("gq"), *kept)


def _costs() -> tuple[Column, Column]:
    """What a base costs an allele that it matches, and another one."""
    e = F.pow(F.lit(10.0), -F.col("bq") / 10.0)
    return F.round(-10000 * F.log10(1 - e)).cast("long"), F.round(-10000 * F.log10(e / 3)).cast("long")


def allele_genotypes(bases: DataFrame) -> DataFrame:
    """Sites with alt (the other base with most reads, ties by letter; null without one), dp, ad_ref, ad_alt, gt, qual and
    gq. A heterozygote explains reference and alt at HET a base; any third base is an error under each genotype. The
    bases of a site are added up by letter before they meet, so a site is at most four rows of a group."""
    match, other = _costs()
    ok = bases.where(F.col("bq") >= MIN_BASE_QUALITY)
    one = ok.groupBy(*SITE, "base_call", "bq").agg(F.count("*").alias("_n"))
    n = F.col("_n")
    each = one.groupBy(*SITE, "base_call").agg(F.sum(n).alias("d"), F.sum(n * match).alias("m"), F.sum(n * other).alias("o"))
    sites = each.groupBy(*SITE).agg(F.array_sort(F.collect_list(F.struct((-F.col("d")).alias("less"), "base_call", "d", "m", "o"))).alias("xs"))
    zero = F.struct(F.lit(0).cast("long").alias("less"), F.lit(None).cast("string").alias("base_call"), *[F.lit(0).cast("long").alias(c) for c in ("d", "m", "o")])
    ref = F.coalesce(F.get(F.filter("xs", lambda x: x["base_call"] == F.col("ref_base")), F.lit(0)), zero)
    alt = F.coalesce(F.get(F.filter("xs", lambda x: x["base_call"] != F.col("ref_base")), F.lit(0)), zero)
    total = lambda c: F.aggregate("xs", F.lit(0).cast("long"), lambda a, x: a + x[c])
    s = sites.select(*SITE, ref.alias("r"), alt.alias("a"), total("d").alias("dp"), total("o").alias("o"))
    s = s.withColumns({
        "rr": F.col("r.m") + F.col("o") - F.col("r.o"), "aa": F.col("a.m") + F.col("o") - F.col("a.o"),
        "ra": HET * (F.col("r.d") + F.col("a.d")) + F.col("o") - F.col("r.o") - F.col("a.o"),
    })
    s = s.withColumn("n_alt", F.col("dp") - F.col("r.d"))
    kept = genotypes(s, "r", "a")
    return kept.select(*SITE, F.col("a.base_call").alias("alt"), "dp", F.col("r.d").alias("ad_ref"), F.col("a.d").alias("ad_alt"), "gt", "qual", "gq")


def indel_genotypes(reads: DataFrame) -> DataFrame:
    """The events of indel_events with dp, the passing primaries that cover the base before and the base after, gt, qual
    and gq: a read either shows the event or does not, and is wrong about it once in a thousand."""
    events = indel_events(reads)
    places = events.select("contig_id", "pos").distinct()
    span = F.col("pos") + R.reference_span(R.cigar(F.col("cigar"))) - 2  # the last base that has one after it in the read
    slim = reads.where(R.is_primary(F.col("flag"))).select("contig_id", F.col("pos").alias("lo"), span.alias("hi")).where("hi >= lo")
    depth = depths(slim, places).select(F.col("contig_id").alias("d_c"), F.col("pos").alias("d_p"), F.col("depth").alias("covering"))
    joined = events.join(depth, (F.col("contig_id") == F.col("d_c")) & (F.col("pos") == F.col("d_p")), "left")
    s = joined.withColumn("dp", F.greatest(F.coalesce("covering", F.lit(0)), F.col("n")))
    right, wrong = round(-10000 * log10(1 - 1e-3)), 30_000
    s = s.withColumns({"rr": right * (F.col("dp") - F.col("n")) + wrong * F.col("n"), "aa": right * F.col("n") + wrong * (F.col("dp") - F.col("n")), "ra": HET * F.col("dp")})
    best = F.least("rr", "ra", "aa")
    second = F.sort_array(F.array("rr", "ra", "aa"))[1]
    return s.select("contig_id", "pos", "op", "len", "n", "dp", _gt(best).alias("gt"), (F.col("rr") - best).alias("qual"), (second - best).alias("gq"))


def bands(calls: DataFrame, edges: tuple[int, int] = (200_000, 600_000)) -> DataFrame:
    """Reference sites in runs of one contig, one quality band and consecutive positions. Sites are numbered by range
    partitions: within a run, position and number grow alike."""
    band = F.when(F.col("gq") < edges[0], 0).when(F.col("gq") < edges[1], 1).otherwise(2)
    ref = calls.where("gt = '0/0'").withColumn("band", band)
    at = numbered(ref.select("contig_id", "band", "rpos", "dp"), ["contig_id", "band", "rpos"])
    return at.withColumn("run", F.col("rpos") - F.col("n")).groupBy("contig_id", "band", "run").agg(F.min("rpos").alias("lo"), F.max("rpos").alias("hi"), F.min("dp").alias("min_dp")).drop("run")


def features(bases: DataFrame) -> DataFrame:
    """Site features: depth, mean square root of mapping quality, and the strand table."""
    ok = bases.where(F.col("bq") >= MIN_BASE_QUALITY)
    ref, rev = F.col("base_call") == F.col("ref_base"), R.has(F.col("flag"), R.REVERSE)
    return ok.groupBy(*SITE).agg(
        F.count("*").alias("dp"), F.round(F.sqrt(F.sum(F.col("mapq") * F.col("mapq")) / F.count("*")), 4).alias("mq"),
        F.count_if(ref & ~rev).alias("ref_fwd"), F.count_if(ref & rev).alias("ref_rev"), F.count_if(~ref & ~rev).alias("alt_fwd"), F.count_if(~ref & rev).alias("alt_rev"),
    )


def indel_events(reads: DataFrame) -> DataFrame:
    """contig_id, pos (the base before the event), op (I or D), len and the number of passing primaries that show it."""
    ops = R.cigar(F.col("cigar"))
    each = F.transform(ops, lambda x, i: F.struct(x["op"].alias("op"), x["len"].alias("len"), R.reference_span(F.slice(ops, F.lit(1), i)).alias("before")))
    found = reads.where(R.is_primary(F.col("flag"))).select("contig_id", "pos", F.explode(F.filter(each, lambda x: x["op"].isin("I", "D"))).alias("x"))
    return found.groupBy("contig_id", (F.col("pos") + F.col("x.before") - 1).alias("pos"), "x.op", "x.len").agg(F.count("*").alias("n"))


def fisher_phred(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Phred-scaled two-sided Fisher test of the table (a b / c d). Tables with the same sums are walked in order; each
    one's weight follows from the one before, taken as a logarithm relative to the observed table's."""
    row, col, other = a + b, a + c, c + d
    low, high = F.greatest(F.lit(0).cast("long"), col - other), F.least(row, col)

    def walk(end: Column) -> Column:
        return F.when(end > low, F.sequence(low + 1, end)).otherwise(F.array().cast("array<bigint>"))

    def grown(k: Column) -> Column:
        return F.log((row - k + 1) * (col - k + 1) / (k * (other - col + k)))

    def added(total: Column, w: Column, when: Column) -> Column:
        return total + F.when(when, F.exp(w)).otherwise(F.lit(0.0))

    observed = F.aggregate(walk(a), F.lit(0.0), lambda x, k: x + grown(k))

    def step(x: Column, k: Column) -> Column:
        w = x["w"] + grown(k)
        return F.struct(w.alias("w"), added(x["tail"], w, w <= 1e-7).alias("tail"), added(x["all"], w, F.lit(True)).alias("all"))

    first = -observed
    start = F.struct(first.alias("w"), added(F.lit(0.0), first, first <= 1e-7).alias("tail"), F.exp(first).alias("all"))
    p = F.aggregate(walk(high), start, step, lambda x: x["tail"] / x["all"])
    return F.abs(F.round(-10 * F.log10(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))), 3))


def strand_odds(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Symmetric odds ratio of the strand table, one added to each cell, weighed by how even either allele's strands are."""
    a, b, c, d = a + 1, b + 1, c + 1, d + 1
    r = a * d / (b * c)
    even = lambda x, y: F.least(x, y) / F.greatest(x, y)
    return F.round(F.log(r + 1 / r) + F.log(even(a, b)) - F.log(even(c, d)), 4)


def annotations(bases: DataFrame) -> DataFrame:
    """dp, fs, mq, qd and sor of the sites that are not reference, from one pass over the bases: what features and likelihoods
    count is counted together."""
    ref, rev = F.col("_ref"), F.col("_rev")
    cell = lambda when, name: F.sum(F.when(when, F.col("_n")).otherwise(0)).alias(name)
    each = _by_quality(bases, F.sum(F.col("mapq") * F.col("mapq")).alias("_squares"))
    names = ("ref_fwd", "ref_rev", "alt_fwd", "alt_rev")
    cells = [cell(when, name) for when, name in zip((ref & ~rev, ref & rev, ~ref & ~rev, ~ref & rev), names)]
    mq = F.round(F.sqrt(F.sum("_squares") / F.sum("_n")), 4).alias("mq")
    called = genotypes(_likelihoods(each, mq, *cells), "mq", *names).where("gt <> '0/0'")
    table = [F.col(c) for c in names]
    qd = F.round(F.col("qual") / 1000 / F.col("dp"), 4)
    return called.select(*SITE, "gt", "dp", fisher_phred(*table).alias("fs"), "mq", qd.alias("qd"), strand_odds(*table).alias("sor"))
