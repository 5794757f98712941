"""Merging, annotating and filtering calls."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionflow.operators.align import blocks
from regionflow.operators.assembly import normalised
from regionflow.operators.ingest import numbered
from regionflow.operators.store import cut

#: Resource, whether known, training, truth, and prior.
RESOURCES = [("hapmap", False, True, True, 10), ("dbsnp", True, False, False, 2), ("omni", True, False, False, 7), ("kg_indel", False, True, False, 10), ("mills", False, True, True, 12)]
TRUTH_LEVEL = 0.99
#: The prior of sites that no resource has, and what is added to the diagonal of a covariance.
NOVEL, RIDGE = 2, 1e-3


def concat_distinct(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping regional calls once, from the first region."""
    w = Window.partitionBy(*keys).orderBy("region")
    return calls.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def annotate(calls: DataFrame, known: DataFrame) -> DataFrame:
    """calls with source, that of the known site (the first by name of several; null for none). Where both have ref and alt
    a site must agree in them too, in each of its alts where those are arrays; otherwise the place alone counts."""
    if dict(known.dtypes).get("alt", "").startswith("array") and "ref" in known.columns:
        known = alleles(known)
    keys = [("contig_id", "contig_id"), ("pos", "pos")]
    if {"ref", "alt"} <= set(calls.columns) & set(known.columns):
        keys += [("ref", "ref"), ("alt", "alt")]
    k = known.groupBy(*[F.col(c).alias(f"k_{c}") for _, c in keys]).agg(F.min("source").alias("source"))
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"k_{d}") for c, d in keys])
    return calls.join(k, on, "left").drop(*[f"k_{c}" for _, c in keys])


def alleles(calls: DataFrame) -> DataFrame:
    """calls with a row for each of their alts, where alt is an array; without null, empty and `*` ones."""
    each = calls.withColumn("alt", F.explode("alt")) if dict(calls.dtypes)["alt"].startswith("array") else calls
    return each.where("alt is not null and alt not in ('', '*', '.')")


def left_aligned(calls: DataFrame, reference: DataFrame, reach: int = 256) -> DataFrame:
    """calls (contig_id, pos, ref, alt, one allele a row) as short and as far left as they go, in upper case: an indel in a
    repeat is told at one place whatever wrote it. A row meets the reach bases before it; those whose repeat goes on
    there are moved again. Alleles of other letters than ACGTN, and places beyond the reference, stay as they are."""
    rest = [c for c in calls.columns if c not in ("contig_id", "pos", "ref", "alt")]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(0)
    left = calls.select("contig_id", F.col("pos").cast("long").alias("pos"), F.upper("ref").alias("ref"), F.upper("alt").alias("alt"), row.alias("row"))
    plain = F.col("ref").rlike("^[ACGTN]+$") & F.col("alt").rlike("^[ACGTN]+$") & F.col("contig_id").isNotNull() & (F.col("pos") > 0)
    done = [left.where(~F.coalesce(plain, F.lit(False)))]
    left = left.where(F.coalesce(plain, F.lit(False)))
    cells = cut(blocks(reference, 1 << 14, reach + 2))
    simple = (F.length("ref") == 1) & (F.length("alt") == 1)
    done.append(left.where(simple))
    left = cut(left.where(~simple))
    while not left.isEmpty():
        from_ = F.greatest(F.col("pos") - reach, F.lit(1))
        block = left.withColumn("_from", from_).withColumn("block", F.floor((F.col("_from") - 1) / (1 << 14)))
        text = F.substring("bases", ((F.col("_from") - 1) % (1 << 14) + 1).cast("int"), (F.col("pos") - F.col("_from")).cast("int"))
        met = block.join(cells, ["contig_id", "block"], "left").withColumn("before", F.coalesce(text, F.lit("")))
        kind = calls.select("contig_id").schema[0].dataType
        moved = met.select(F.col("contig_id").cast("long").alias("contig_id"), "pos", "ref", "alt", "before", "row").mapInArrow(_moved, "contig_id long, pos long, ref string, alt string, " + f"row {met.schema['row'].dataType.simpleString()}, open boolean")
        moved = cut(moved.withColumn("contig_id", F.col("contig_id").cast(kind)))
        done.append(moved.where("not open").drop("open"))
        left = cut(moved.where("open").drop("open"))
    out = reduce(DataFrame.unionByName, done)
    return out.select("contig_id", "pos", "ref", "alt", *([f"row.{c}" for c in rest]))


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For left_aligned: the allele moved over the bases before it, and whether it may go on before them."""
    for b in batches:
        pos, ref, alt, open_ = [], [], [], []
        for p, r, a, before in zip(*(b.column(c).to_pylist() for c in ("pos", "ref", "alt", "before"))):
            at, old, new = normalised(before + r, len(before), r, a)
            pos.append(p - len(before) + at)
            ref.append(old)
            alt.append(new)
            open_.append(at == 0 and pos[-1] > 1 and p > pos[-1] and len(old) != len(new))
        columns = [b.column("contig_id"), pa.array(pos, pa.int64()), pa.array(ref), pa.array(alt), b.column("row"), pa.array(open_)]
        yield pa.RecordBatch.from_arrays(columns, ["contig_id", "pos", "ref", "alt", "row", "open"])


def with_ids(calls: DataFrame, known: DataFrame, reference: DataFrame) -> DataFrame:
    """calls (contig_id, pos, ref, alts) with id, the ids of the known sites (contig_id, pos, ref, alt, id) that have one of
    their alleles, in order with `;` between them, null for none. Both sides are split by allele and left-aligned first."""
    sites = left_aligned(alleles(known.where("id is not null")), reference).select(*[F.col(c).alias(f"k_{c}") for c in ("contig_id", "pos", "ref", "alt")], F.explode(F.split("id", ";")).alias("id"))
    own = calls.withColumn("_row", F.struct("contig_id", "pos", "ref"))
    each = left_aligned(alleles(own.select("contig_id", "pos", "ref", F.col("alts").alias("alt"), "_row")), reference)
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"k_{c}") for c in ("contig_id", "pos", "ref", "alt")])
    ids = each.join(sites, on).groupBy("_row").agg(F.array_join(F.array_sort(F.collect_set("id")), ";").alias("id"))
    return own.join(ids, "_row", "left").drop("_row")


def label(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """calls with is_known, is_training, is_truth and the largest prior of the resources that have the site."""
    named = lambda i: [r[0] for r in RESOURCES if r[i]]
    prior = F.element_at(F.create_map(*[F.lit(x) for r in RESOURCES for x in (r[0], r[4])]), F.col("name"))
    s = sites.groupBy(F.col("contig_id").alias("s_c"), F.col("pos").alias("s_p")).agg(
        *[F.bool_or(F.col("name").isin(named(i))).alias(c) for i, c in ((1, "is_known"), (2, "is_training"), (3, "is_truth"))], F.max(prior).alias("prior")
    )
    out = calls.join(s, (F.col("contig_id") == F.col("s_c")) & (F.col("pos") == F.col("s_p")), "left").drop("s_c", "s_p")
    return out.fillna(False, ["is_known", "is_training", "is_truth"]).fillna(0, ["prior"])


def tranche_cut(scored: DataFrame, level: float = TRUTH_LEVEL) -> DataFrame:
    """One row: the score that keeps `level` of the truth sites, null if there are none. Truth sites are numbered by range
    partitions from the best score on; the one at the level's place has it."""
    truth = scored.where("is_truth").select("score", (-F.col("score")).alias("_down"))
    total = scored.agg(F.count_if("is_truth").alias("total"))
    return numbered(truth, ["_down"]).crossJoin(total).where(F.col("n") == F.ceil(level * F.col("total")) - 1).agg(F.max("score").alias("cut"))  # total: one row


def apply_cut(scored: DataFrame, cut: DataFrame, level: float = TRUTH_LEVEL) -> DataFrame:
    """scored with filter: PASS from the cut (one row) on, the tranche's name below it; a null cut lets nothing pass."""
    return scored.crossJoin(cut).withColumn("filter", F.when(F.col("score") >= F.col("cut"), "PASS").otherwise(f"VQSRTranche{100 * level:.1f}")).drop("cut")


def _standardised(sites: DataFrame, columns: list[str], training: str) -> DataFrame:
    """sites with z_<column>; mean and spread are those of the training sites."""
    stats = sites.where(training).agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    if stats[0] is None:
        raise ValueError("no training sites")
    std = [((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)).alias(f"z_{c}") for c in columns]
    return sites.select("*", *std)


#: Of the variational mixture: the weight that a component has before any site, sites that its mean and its spread count as
#: beforehand, rounds at most, and the change of the means that ends it.
WEIGHT, SHRINKAGE, COUNTS, ROUNDS, SETTLED = 1e-3, 1.0, 20.0, 60, 1e-8


def _psi(x: float) -> float:
    """The derivative of the logarithm of the gamma function: its recurrence up to 10, then its asymptotic series."""
    out = 0.0
    while x < 10:
        out, x = out - 1 / x, x + 1
    y = 1 / (x * x)
    return out + log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def variational(rows: DataFrame, columns: list[str], k: int, rounds: int = ROUNDS) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Weight, mean and covariance of each of k Gaussians by variational Bayes over z_<column> of rows. A round is one pass:
    tasks add up, for each component, its share of the rows, of their values and of products of values, and the driver
    works the posterior out from these sums alone. The start is along the first principal direction, so that the same
    rows give the same mixture."""
    z, d = [F.col(f"z_{c}") for c in columns], len(columns)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    first = rows.agg(F.count("*"), *[F.sum(x) for x in z], *[F.sum(z[i] * z[j]) for i, j in upper]).first()
    n = float(first[0])

    def square(values) -> np.ndarray:
        out = np.zeros((d, d))
        for (i, j), v in zip(upper, values):
            out[i, j] = out[j, i] = v
        return out

    centre = np.array(first[1 : d + 1], float) / n
    cov = square(first[d + 1 :]) / n - np.outer(centre, centre) + RIDGE * np.eye(d)
    values, vectors = np.linalg.eigh(cov)
    main = vectors[:, -1] * (1 if vectors[np.abs(vectors[:, -1]).argmax(), -1] > 0 else -1) * np.sqrt(values[-1])
    means = [centre + main * c for c in np.linspace(-1.5, 1.5, k)]
    alpha, beta, nu = np.full(k, WEIGHT + n / k), np.full(k, SHRINKAGE + n / k), np.full(k, COUNTS + n / k)
    scales = [np.linalg.inv(cov) / x for x in nu]
    prior = np.eye(d) * COUNTS  # spread 1, as the standardised sites have
    for _ in range(rounds):
        terms = []
        for m, w, x in zip(means, scales, range(k)):
            log_det = sum(_psi((nu[x] - i) / 2) for i in range(d)) + d * log(2) + float(np.linalg.slogdet(w)[1])
            const = _psi(alpha[x]) - _psi(alpha.sum()) + log_det / 2 - d / 2 * log(2 * pi) - d / (2 * beta[x])
            diff = [c - float(v) for c, v in zip(z, m)]
            dist = sum(diff[i] * diff[j] * float(nu[x] * w[i, j] * (1 if i == j else 2)) for i, j in upper)
            terms.append(F.lit(const) - dist / 2)
        top = F.greatest(*terms) if k > 1 else terms[0]
        raw = rows.select(*z, *[t.alias(f"t{x}") for x, t in enumerate(terms)], top.alias("top"))
        shared = raw.select(*z, *[F.exp(F.col(f"t{x}") - F.col("top")).alias(f"e{x}") for x in range(k)])
        whole = sum((F.col(f"e{x}") for x in range(1, k)), F.col("e0"))
        parts = shared.select(*z, *[(F.col(f"e{x}") / whole).alias(f"r{x}") for x in range(k)])
        sums = parts.agg(*[f for x in range(k) for r in [F.col(f"r{x}")] for f in (F.sum(r), *[F.sum(r * c) for c in z], *[F.sum(r * z[i] * z[j]) for i, j in upper])]).first()
        size = 1 + d + len(upper)
        moved = 0.0
        for x in range(k):
            own = sums[x * size : (x + 1) * size]
            share, total, products = float(own[0]), np.array(own[1 : d + 1], float), square(own[d + 1 :])
            alpha[x], beta[x], nu[x] = WEIGHT + share, SHRINKAGE + share, COUNTS + share
            new = total / beta[x]  # the mean of sites is 0 beforehand
            moved = max(moved, float(np.abs(new - means[x]).max()))
            means[x] = new
            spread = prior + products - beta[x] * np.outer(new, new)
            scales[x] = np.linalg.inv((spread + spread.T) / 2)
        if moved < SETTLED:
            break
    return [(float(a / alpha.sum()), m, np.linalg.inv(v * w)) for a, m, v, w in zip(alpha, means, nu, scales)]


def _gaussians(rows: DataFrame, columns: list[str], k: int) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Weight, mean and covariance of each of k Gaussians fitted to z_<column>."""
    if k == 1:
        z = [f"z_{c}" for c in columns]
        got = rows.agg(*[F.avg(x) for x in z], *[F.covar_pop(x, y) for x in z for y in z]).first()
        n = len(z)
        return [(1.0, np.array(got[:n], float), np.array(got[n:], float).reshape(n, n))]
    return variational(cut(rows.select(*[f"z_{c}" for c in columns])), columns, k)


def _log_density(rows: DataFrame, columns: list[str], k: int) -> Column:
    """The log density under k Gaussians fitted to rows, as an expression over z_<column>."""
    terms = []
    for weight, mean, cov in _gaussians(rows, columns, k):
        inv = np.linalg.inv(cov + RIDGE * np.eye(len(columns)))
        diff = [F.col(f"z_{c}") - float(m) for c, m in zip(columns, mean)]
        dist = sum(diff[i] * diff[j] * float(inv[i, j]) for i in range(len(columns)) for j in range(len(columns)))
        const = log(weight + 1e-12) + 0.5 * float(np.linalg.slogdet(inv)[1]) - len(columns) / 2 * log(2 * pi)
        terms.append(F.lit(const) - dist / 2)
    top = F.greatest(*terms) if len(terms) > 1 else terms[0]
    return top + F.log(sum(F.exp(t - top) for t in terms))


def mixture_scores(sites: DataFrame, columns: list[str], training: str, k: int = 2) -> DataFrame:
    """sites with score, the log density under a Gaussian mixture of the standardised training sites."""
    v = _standardised(sites, columns, training)
    return v.withColumn("score", _log_density(v.where(training), columns, k)).drop(*[f"z_{c}" for c in columns])


def vqslod(sites: DataFrame, columns: list[str], training: str, prior: str, k: int = 2, worst: float = 0.05) -> DataFrame:
    """sites with vqslod: log10 odds of the model of the training sites against one of the worst share of all sites by
    that model, plus the log10 odds of the phred-scaled prior (NOVEL at least). One Gaussian describes the worst."""
    v = cut(_standardised(sites, columns, training))
    good = _log_density(v.where(training), columns, k)
    edge = v.agg(F.percentile_approx(good, worst, 10_000)).first()[0]
    bad = _log_density(v.where(good <= edge), columns, 1)
    p = 1 - F.pow(F.lit(10.0), -F.greatest(F.col(prior), F.lit(NOVEL)) / 10)
    return v.withColumn("vqslod", (good - bad) / log(10) + F.log10(p / (1 - p))).drop(*[f"z_{c}" for c in columns])


def recalibrate(sites: DataFrame, columns: list[str], level: float = TRUTH_LEVEL, modes: tuple[str, ...] = ("SNP", "INDEL"), k: int = 2) -> DataFrame:
    """sites (mode, is_training, is_truth, prior and the columns) with vqslod and filter: each mode is scored by a model of
    its own training sites, and its truth sites set the cut. Sites of another mode, or of one that has no training sites,
    keep a null vqslod and filter."""
    done = []
    trained = [r[0] for r in sites.where("is_training").select("mode").distinct().collect() if r[0] in modes]  # modes at most
    for mode in trained:
        scored = vqslod(sites.where(F.col("mode") == mode), columns, "is_training", "prior", k).withColumn("score", F.round("vqslod", 6))
        done.append(apply_cut(scored, tranche_cut(scored, level), level).drop("score"))
    rest = sites.where(F.col("mode").isNull() | ~F.col("mode").isin(trained)) if trained else sites
    done.append(rest.withColumn("vqslod", F.lit(None).cast("double")).withColumn("filter", F.lit(None).cast("string")))
    return reduce(DataFrame.unionByName, done)
