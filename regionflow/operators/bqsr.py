"""Reads as bases, and base quality recalibration over bases (contig_id, rpos, cycle, flag, bq, ref_base, base_call,
rec_id, and before, the call before in the read, where there is one)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.align import blocks
from regionflow.operators.store import cut


#: Records whose bases count nowhere.
SKIPPED = R.UNMAPPED | R.SECONDARY | R.QCFAIL | R.DUPLICATE


def explode(reads: DataFrame, least_mapq: int = 0) -> DataFrame:
    """A row per base of reads (contig_id, pos, flag, cigar, seq, qual, and columns that are kept) that stands over a
    base of the reference: rpos, cycle (its place in seq from 1, clips and insertions counted), bq, base_call, before
    (the call before in seq; null for a first one) in place of pos, cigar, seq and qual.

    Clipped and inserted bases, N, and records that are unmapped, secondary, failing or flagged as duplicates have no
    rows; nor have records without sequence, qualities or CIGAR, or below least_mapq (a null mapq is 0), if
    that is above 0. Supplementary ones stay. A CIGAR or qualities of
    another length than the sequence are an error."""
    kept = [F.col(f"`{c}`") for c in reads.columns if c not in ("pos", "cigar", "seq", "qual")]
    used = reads.where((F.col("flag").bitwiseAND(SKIPPED) == 0) & (F.col("seq") != "*") & (F.col("qual") != "*") & (F.col("cigar") != "*"))
    if least_mapq > 0:
        used = used.where(F.coalesce("mapq", F.lit(0)) >= least_mapq)
    ops = F.col("_ops")  # parsed once, not for each of its uses
    fits = (R.cigar_sum(ops, "MIS=X") == F.length("seq")) & (F.length("qual") == F.length("seq"))
    used = used.withColumn("_ops", R.cigar(F.col("cigar")))
    used = used.withColumn("_ops", F.when(fits, ops).otherwise(F.raise_error(F.concat_ws(" ", F.lit("lengths differ:"), "cigar", "seq", "qual"))))
    each = F.transform(ops, lambda x, i: F.struct(x["op"].alias("op"), x["len"].alias("len"), R.reference_span(F.slice(ops, F.lit(1), i)).alias("ref"), R.cigar_sum(F.slice(ops, F.lit(1), i), "MIS=X").alias("own")))
    runs = used.select(*kept, "pos", "seq", "qual", F.explode(F.filter(each, lambda x: x["op"].isin("M", "=", "X") & (x["len"] > 0))).alias("_run"))
    bases = runs.select("*", F.explode(F.sequence(F.lit(1), F.col("_run.len"))).alias("_k")).withColumn("cycle", F.col("_run.own") + F.col("_k"))
    call = lambda at: F.upper(F.substring("seq", at, 1))
    return bases.select(
        *kept, (F.col("pos") + F.col("_run.ref") + F.col("_k") - 1).alias("rpos"), "cycle", (F.ascii(F.substring("qual", F.col("cycle"), 1)) - 33).alias("bq"),
        call(F.col("cycle")).alias("base_call"), F.when(F.col("cycle") > 1, call(F.col("cycle") - 1)).alias("before"),
    ).where("base_call <> 'N'")


#: Bases of a block of known sites.
BLOCK = 512


def over_reference(reads: DataFrame, reference: DataFrame, known: DataFrame | None = None, least_mapq: int = 0) -> DataFrame:
    """explode of reads, bases over ACGT of the reference (contig_id, line, width, seq) alone, with ref_base, and with masked
    if known sites (contig_id, pos, and ref, whose length they cover) are given. Reads meet blocks of the reference and of
    the sites, as long as the longest span behind each, before they become bases."""
    used = reads.where((F.col("flag").bitwiseAND(SKIPPED) == 0) & (F.col("cigar") != "*")).withColumn("_start", F.col("pos"))
    spans = cut(used.withColumn("_span", R.reference_span(R.cigar(F.col("cigar")))))
    longest = int(spans.agg(F.max("_span")).first()[0] or 0)  # one number
    size = 1 << 14
    first = F.floor((F.col("pos") - 1) / size)
    met = spans.withColumn("block", first).join(blocks(reference, size, longest + 1), ["contig_id", "block"])
    met = met.withColumn("_text", F.substring("bases", ((F.col("pos") - 1) % size + 1).cast("int"), F.col("_span"))).drop("block", "bases")
    extra = ["_start", "_span", "_text"]
    if known is not None:
        wide = F.greatest(F.coalesce(F.length("ref"), F.lit(1)), F.lit(1)) if "ref" in known.columns else F.lit(1)
        site = known.where("contig_id is not null and pos is not null").select("contig_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + wide - 1)).alias("at")).distinct()
        b = F.floor(F.col("at") / BLOCK)
        cell = site.withColumn("_b", F.explode(F.sequence(F.floor((F.col("at") - longest) / BLOCK), b))).where(F.col("at") < (F.col("_b") + 1) * BLOCK + longest)
        listed = cell.groupBy(F.col("contig_id").alias("_c"), "_b").agg(F.collect_list("at").alias("_sites"))
        met = met.withColumn("_a", F.floor(F.col("pos") / BLOCK)).join(listed, (F.col("contig_id") == F.col("_c")) & (F.col("_a") == F.col("_b")), "left")
        own = F.filter(F.coalesce("_sites", F.array().cast("array<bigint>")), lambda x: x.between(F.col("_start"), F.col("_start") + F.col("_span")))
        met = met.withColumn("_known", own).drop("_c", "_b", "_a", "_sites")
        extra.append("_known")
    bases = explode(met, least_mapq).withColumn("ref_base", F.substring("_text", (F.col("rpos") - F.col("_start") + 1).cast("int"), F.lit(1)))
    if known is not None:
        bases = bases.withColumn("masked", F.array_contains("_known", F.col("rpos")))
    return bases.where("ref_base in ('A', 'C', 'G', 'T')").drop(*extra)


def with_covariates(bases: DataFrame) -> DataFrame:
    """bases with cyc (negative for the second mate) and ctx (the base before and the base; null for a first base, and
    after N). Without a column before, the base before is that of the last cycle that bases has."""
    own = "before" in bases.columns
    before = F.when(F.col("before") != "N", F.col("before")) if own else F.lag("base_call").over(Window.partitionBy("rec_id").orderBy("cycle"))
    cyc = F.when(R.has(F.col("flag"), R.READ2), -F.col("cycle")).otherwise(F.col("cycle"))
    return bases.withColumn("cyc", cyc).withColumn("ctx", F.concat(before, F.col("base_call")))


def covariates(bases: DataFrame, *groups: str) -> DataFrame:
    """contig_id, rpos, q, cyc, ctx, miss, and the columns that further part the tables, such as the read group. Known sites
    are masked after this: the context of a base is that of the read, whatever is masked beside it."""
    return with_covariates(bases).select("contig_id", "rpos", F.col("bq").alias("q"), "cyc", "ctx", (F.col("base_call") != F.col("ref_base")).alias("miss"), *groups)


def unknown_only(bases: DataFrame, known: DataFrame) -> DataFrame:
    """bases (contig_id, rpos) at no known site (contig_id, pos). Where known has a column ref, a site covers as many
    bases as ref is long, so that deletions mask all that they take; a null or empty ref covers one."""
    at = F.col("pos")
    if "ref" in known.columns:
        at = F.explode(F.sequence(at, at + F.greatest(F.coalesce(F.length("ref"), F.lit(1)), F.lit(1)) - 1))
    k = known.where("contig_id is not null and pos is not null").select(F.col("contig_id").alias("k_c"), at.alias("k_p")).distinct()
    return bases.join(k, (F.col("contig_id") == F.col("k_c")) & (F.col("rpos") == F.col("k_p")), "left_anti")


def tabulate(cov: DataFrame, *keys: str) -> DataFrame:
    """obs and err of each value of the keys: what a region adds to the tables."""
    return cov.groupBy(*keys).agg(F.count("*").alias("obs"), F.count_if("miss").alias("err"))


def gather(partials: DataFrame, *keys: str) -> DataFrame:
    """The regions' tables added up, with the empirical quality emp_q."""
    out = partials.groupBy(*keys).agg(F.sum("obs").alias("obs"), F.sum("err").alias("err"))
    return out.withColumn("emp_q", empirical(F.col("err"), F.col("obs")))


def empirical(err: Column, obs: Column) -> Column:
    return F.round(-10 * F.log10((err + 1) / (obs + 2)), 4)


def marginals(cov: DataFrame, *groups: str) -> DataFrame:
    """All covariate tables in one pass, those of each value of groups apart; g_* tell rolled-up keys from null ones."""
    own = [F.col(c) for c in groups]
    sets = [own, [*own, F.col("q")], [*own, F.col("q"), F.col("cyc")], [*own, F.col("q"), F.col("ctx")]]
    # Counted once by all keys: what is added up to each table is a row per combination, not four per base.
    return tabulate(cov, *groups, "q", "cyc", "ctx").groupingSets(sets, *groups, "q", "cyc", "ctx").agg(
        F.sum("obs").alias("obs"), F.sum("err").alias("err"),
        F.grouping("q").cast("int").alias("g_q"), F.grouping("cyc").cast("int").alias("g_cyc"), F.grouping("ctx").cast("int").alias("g_ctx"),
    )


def _shifted(shift: Column) -> Column:
    """bq shifted, rounded, within 1 and 60; below 6 unchanged."""
    new = F.greatest(F.lit(1), F.least(F.lit(60), F.floor(F.round(F.col("bq") + shift, 4) + 0.5).cast("int")))
    return F.when(F.col("bq") >= 6, new).otherwise(F.col("bq"))


def apply_quality(bases: DataFrame, table: DataFrame) -> DataFrame:
    """bases with new_q by the quality alone: shifted by emp_q - q where table (q, emp_q) has bq."""
    d = table.select(F.col("q").alias("d_q"), (F.col("emp_q") - F.col("q")).alias("delta"))  # a row per quality
    return bases.join(F.broadcast(d), F.col("bq") == F.col("d_q"), "left").withColumn("new_q", _shifted(F.coalesce("delta", F.lit(0.0)))).drop("d_q", "delta")


def apply(bases: DataFrame, table: DataFrame, *groups: str) -> DataFrame:
    """bases with new_q, rounded, within 1 and 60, below 6 unchanged: bq and its shifts by table (of marginals with the
    same groups, whose columns bases has).

    The shift of all bases is from the quality that their reported errors make up to the empirical one, that of a
    quality goes on to its own empirical one, and those of a cycle and a context go from there to theirs within the
    quality; each value of groups has shifts of its own. What table does not have, and the missing context of a first
    base, shifts nothing. table has as many rows as groups times qualities times cycles and contexts; it is kept first.
    """
    t = cut(table.withColumn("emp", empirical(F.col("err"), F.col("obs"))))
    level = lambda q, cyc, ctx: t.where((F.col("g_q") == q) & (F.col("g_cyc") == cyc) & (F.col("g_ctx") == ctx))
    named = lambda k: [F.col(c).alias(f"{k}_{c}") for c in groups]
    on = lambda k, *conditions: reduce(lambda a, b: a & b, [*(F.col(c).eqNullSafe(F.col(f"{k}_{c}")) for c in groups), *conditions], F.lit(True))
    reported = level(0, 1, 1).groupBy(*named("p")).agg((-10 * F.log10(F.sum(F.col("obs") * F.pow(F.lit(10.0), -F.col("q") / 10.0)) / F.sum("obs"))).alias("reported"))
    everything = level(1, 1, 1).join(F.broadcast(reported), on("p")).select(*named("a"), F.round(F.col("emp") - F.col("reported"), 4).alias("d_all"))
    by_q = level(0, 1, 1).join(F.broadcast(everything), on("a")).select(*named("k"), F.col("q").alias("k_q"), F.col("emp").alias("emp_q"), (F.col("emp") - F.col("q") - F.col("d_all")).alias("d_q"))
    own = by_q.drop("d_q")
    with_own = lambda df: df.join(F.broadcast(own), on("k", F.col("q") == F.col("k_q")))
    by_cyc = with_own(level(0, 0, 1)).select(*named("c"), F.col("q").alias("c_q"), F.col("cyc").alias("c_cyc"), (F.col("emp") - F.col("emp_q")).alias("d_cyc"))
    by_ctx = with_own(level(0, 1, 0).where("ctx is not null")).select(*named("x"), F.col("q").alias("x_q"), F.col("ctx").alias("x_ctx"), (F.col("emp") - F.col("emp_q")).alias("d_ctx"))
    joined = (
        with_covariates(bases).join(F.broadcast(everything), on("a"), "left")
        .join(F.broadcast(by_q.drop("emp_q")), on("k", F.col("bq") == F.col("k_q")), "left")
        .join(F.broadcast(by_cyc), on("c", F.col("bq") == F.col("c_q"), F.col("cyc") == F.col("c_cyc")), "left")
        .join(F.broadcast(by_ctx), on("x", F.col("bq") == F.col("x_q"), F.col("ctx") == F.col("x_ctx")), "left")
    )
    shifts = [F.coalesce(c, F.lit(0.0)) for c in ("d_all", "d_q", "d_cyc", "d_ctx")]
    gone = ["k_q", "c_q", "c_cyc", "x_q", "x_ctx", "d_all", "d_q", "d_cyc", "d_ctx", *(f"{k}_{c}" for k in "akcx" for c in groups)]
    return joined.withColumn("new_q", _shifted(shifts[0] + shifts[1] + shifts[2] + shifts[3])).drop(*gone)


def rewrite(reads: DataFrame, recalibrated: DataFrame) -> DataFrame:
    """reads (rec_id, qual, ...) with the qualities of recalibrated bases (rec_id, cycle, new_q) in qual; bases that have
    no row, such as clipped and inserted ones, keep theirs, and so do reads without any. One row per read is joined."""
    new = recalibrated.groupBy(F.col("rec_id").alias("_rec")).agg(F.map_from_entries(F.collect_list(F.struct("cycle", "new_q"))).alias("_new"))
    letter = lambda c, i: F.coalesce(F.chr(F.try_element_at("_new", i + 1) + 33), c)
    qual = F.array_join(F.transform(F.split("qual", ""), letter), "")
    joined = reads.join(new, F.col("rec_id") == F.col("_rec"), "left")
    return joined.withColumn("qual", F.when(F.col("_new").isNull(), F.col("qual")).otherwise(qual)).select(*reads.columns)
