import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionflow.operators import variants as V
from regionflow.plans.fixture import Genome
from regionflow.plans.queries import QUERIES, labelled
from regionflow.operators import calling


def psi(x):
    """By a difference of the logarithm of the gamma function, and the recurrence to where that is exact enough."""
    return psi(x + 1) - 1 / x if x < 100 else math.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x**4)


def plain_mixture(x, k, rounds=V.ROUNDS):
    """The variational updates over an array, a row a site."""
    n, d = x.shape
    cov = np.cov(x.T, bias=True).reshape(d, d) + V.RIDGE * np.eye(d)
    values, vectors = np.linalg.eigh(cov)
    v = vectors[:, -1]
    v = v * np.sign(v[np.abs(v).argmax()]) * math.sqrt(values[-1])
    means = x.mean(axis=0) + np.linspace(-1.5, 1.5, k)[:, None] * v
    alpha, beta, nu = np.full(k, V.WEIGHT + n / k), np.full(k, V.SHRINKAGE + n / k), np.full(k, V.COUNTS + n / k)
    w = np.array([np.linalg.inv(cov) / a for a in nu])
    for _ in range(rounds):
        rho = np.empty((n, k))
        for c in range(k):
            diff = x - means[c]
            log_det = sum(psi((nu[c] - i) / 2) for i in range(d)) + d * math.log(2) + np.linalg.slogdet(w[c])[1]
            rho[:, c] = psi(alpha[c]) - psi(alpha.sum()) + log_det / 2 - d / 2 * math.log(2 * math.pi) - (d / beta[c] + nu[c] * np.einsum("ni,ij,nj->n", diff, w[c], diff)) / 2
        r = np.exp(rho - rho.max(axis=1, keepdims=True))
        r /= r.sum(axis=1, keepdims=True)
        share = r.sum(axis=0)
        alpha, beta, nu = V.WEIGHT + share, V.SHRINKAGE + share, V.COUNTS + share
        new = (r.T @ x) / beta[:, None]
        w = np.array([np.linalg.inv(V.COUNTS * np.eye(d) + (x * r[:, [c]]).T @ x - beta[c] * np.outer(new[c], new[c])) for c in range(k)])
        moved, means = np.abs(new - means).max(), new
        if moved < V.SETTLED:
            break
    return [(alpha[c] / alpha.sum(), means[c], np.linalg.inv(nu[c] * w[c])) for c in range(k)]


def density(x, parts):
    terms = []
    for weight, mean, cov in parts:
        cov = cov + V.RIDGE * np.eye(len(mean))
        diff = x - mean
        terms.append(math.log(weight + 1e-12) - (len(mean) * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + np.einsum("ni,ij,nj->n", diff, np.linalg.inv(cov), diff)) / 2)
    terms = np.array(terms)
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def moments(x):
    return [(1.0, x.mean(axis=0), np.cov(x.T, bias=True))]


def plain_vqslod(x, training, prior, k, worst=0.05):
    mean, spread = x[training].mean(axis=0), x[training].std(axis=0)
    z = (x - mean) / np.where(spread == 0, 1, spread)
    good = density(z, plain_mixture(z[training], k) if k > 1 else moments(z[training]))
    edge = np.sort(good)[max(0, math.ceil(worst * len(good)) - 1)]
    bad = density(z, moments(z[good <= edge]))
    p = 1 - 10 ** (-np.maximum(prior, V.NOVEL) / 10)
    return (good - bad) / math.log(10) + np.log10(p / (1 - p))


@pytest.mark.parametrize("k", [1, 2, 4])
def test_mixture_equals_plain_updates(spark, k):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal([1, -2, 0], [1, 0.5, 2], (300, 3)), rng.normal([-3, 2, 1], 0.7, (150, 3)), rng.normal(0, 3, (30, 3))])
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], "z_a double, z_b double, z_c double").repartition(5)
    got, want = V.variational(frame, ["a", "b", "c"], k), plain_mixture(x, k)
    for (a, m, c), (b, n, e) in zip(got, want):
        assert abs(a - b) < 1e-6 and np.abs(m - n).max() < 1e-6 and np.abs(c - e).max() < 1e-6
    assert V._psi(0.37) == pytest.approx(psi(0.37), abs=1e-10)


def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        fine = rng.random() < 0.8
        rows.append((i, "SNP" if rng.random() < 0.6 else "INDEL", rng.gauss(30, 4) if fine else rng.gauss(10, 6), rng.gauss(60, 1) if fine else rng.gauss(50, 6), fine and rng.random() < 0.6, rng.choice([0, 2, 7, 12])))
    return rows, spark.createDataFrame(rows, "i int, mode string, dp double, mq double, is_training boolean, prior int").withColumn("is_truth", F.col("is_training"))


def test_scores_and_filters_equal_plain_ones(spark):
    rows, frame = table(spark)
    got = {r.i: (r.vqslod, r["filter"]) for r in V.recalibrate(frame, ["dp", "mq"]).collect()}
    for mode in ("SNP", "INDEL"):
        own = [r for r in rows if r[1] == mode]
        lod = plain_vqslod(np.array([r[2:4] for r in own]), np.array([r[4] for r in own]), np.array([r[5] for r in own]), 2)
        truth = sorted((round(v, 6) for v, r in zip(lod, own) if r[4]), reverse=True)
        cut = truth[math.ceil(0.99 * len(truth)) - 1]
        for v, r in zip(lod, own):
            assert got[r[0]][0] == pytest.approx(v, abs=1e-5)
            if abs(v - cut) > 1e-5:
                assert got[r[0]][1] == ("PASS" if v >= cut else "VQSRTranche99.0")


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_the_queries_equal_plain_scores(spark):
    folder = FOLDER
    g = Genome(spark, folder)
    t = labelled(g).select(F.col("contig_id").alias("c"), F.col("pos").alias("p"), "is_training", "prior")
    rows = calling.annotations(g.bases()).join(t, (F.col("contig_id") == F.col("c")) & (F.col("rpos") == F.col("p"))).select("contig_id", "rpos", F.col("dp").cast("double"), "fs", "mq", "qd", "sor", "is_training", "prior").collect()
    x = np.array([[r.dp, r.fs, r.mq, r.qd, r.sor] for r in rows])
    lod = plain_vqslod(x, np.array([r.is_training for r in rows]), np.array([r.prior for r in rows]), 2)
    got = {(r.contig_id, r.rpos): r.vqslod for r in QUERIES["vqsr_gmm"](spark, folder).collect()}
    assert len(got) == len(rows) > 20
    for r, v in zip(rows, lod):
        assert got[r.contig_id, r.rpos] == pytest.approx(v, abs=2e-4)
