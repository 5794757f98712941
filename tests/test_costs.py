"""What is done for each base or tag shows in the plan: no base moves, and what is costly is done once."""

import os

import pytest
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators import bqsr, calling
from regionflow.plans.fixture import Genome

TABLES = "/root/testdata/sf0.001"
BASES = "rec_id string, contig_id int, rpos long, cycle int, flag int, mapq int, bq int, ref_base string, base_call string, before string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tags_are_split_once(spark):
    df = spark.createDataFrame([(["NM:i:3", "XB:B:i,1,2", "NM:i:4"],)], "f array<string>").select(R.tags(F.col("f")).alias("t"))
    assert plan(df).count(", :, 3)") == 1
    row = df.select("t.NM.i", "t.XB.b").first()
    assert (row.i, row.b) == (4, [1, 2])


def test_logarithms_are_taken_of_a_row_per_quality(spark):
    bases = spark.createDataFrame([("r", 0, 1, 1, 0, 60, 30, "A", "C", None)] * 5 + [("s", 0, 1, 1, 16, 50, 20, "A", "A", None)] * 2, BASES)
    for made in (calling.likelihoods, calling.allele_genotypes, calling.annotations):
        text = plan(made(bases))
        inner = text[text.rindex("Aggregate"):]
        assert "LOG10" not in inner.upper() and text.count("Aggregate") >= 2 and "Join" not in text
    row = calling.likelihoods(bases).first()
    assert (row.dp, row.n_alt, row.rr, row.aa, row.ra) == (7, 5, 5 * 34771 + 2 * 44, 5 * 4 + 2 * 24771, 7 * calling.HET)


def test_tables_of_marginals_are_made_of_counted_rows(spark):
    cov = spark.createDataFrame([(0, 1, 30, 1, "AC", True), (0, 2, 30, 2, None, False)], "contig_id int, rpos long, q int, cyc int, ctx string, miss boolean")
    text = plan(bqsr.marginals(cov))
    assert "Aggregate" in text[text.index("Expand"):]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
def test_contexts_move_no_base(spark):
    g = Genome(spark, TABLES)
    assert "Window" not in plan(bqsr.covariates(g.bases()))
    by_lag = bqsr.with_covariates(g.bases().drop("before")).select("rec_id", "cycle", "ctx")
    own = bqsr.with_covariates(g.bases()).select("rec_id", "cycle", "ctx")
    assert own.exceptAll(by_lag).count() == 0 and by_lag.exceptAll(own).count() == 0
