"""Ingest: filters, counters, mate pairing and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.store import cut

CHUNK_PAIRS = 750_000


def counters(reads: DataFrame) -> DataFrame:
    """Exclusive counters of one pass: secondary first, then quality failures."""
    f = F.col("flag")
    sec = R.has(f, R.SECONDARY)
    return reads.agg(F.count("*").alias("total"), F.count_if(sec).alias("secondary"), F.count_if(~sec & R.has(f, R.QCFAIL)).alias("qcfail"))


def passing(reads: DataFrame, supplementary: bool = False) -> DataFrame:
    """Records that are neither secondary nor failing, nor supplementary unless those are asked for; a null flag goes."""
    drop = R.SECONDARY | R.QCFAIL | (0 if supplementary else R.SUPPLEMENTARY)
    return reads.where(F.col("flag").bitwiseAND(drop) == 0)


def name_classes(reads: DataFrame) -> DataFrame:
    """qname, n1, n2 and what its passing records are: pair, orphan or ambiguous. Records without a name are an orphan each."""
    f = F.col("flag")
    own = F.when(F.col("qname").isNull(), F.monotonically_increasing_id())
    g = passing(reads).withColumn("_own", own).groupBy("qname", "_own").agg(F.count_if(R.has(f, R.READ1)).alias("n1"), F.count_if(~R.has(f, R.READ1)).alias("n2"))
    kind = F.when((F.col("n1") == 1) & (F.col("n2") == 1), "pair").when(F.col("n1") + F.col("n2") == 1, "orphan").otherwise("ambiguous")
    return g.withColumn("kind", kind).drop("_own")


def pairs(reads: DataFrame) -> DataFrame:
    """qname with the ids of its two mates, where a name has one passing record of each; no name makes no pair."""
    f = F.col("flag")
    ok = passing(reads).where("qname is not null")
    g = ok.groupBy("qname").agg(
        F.count("*").alias("n"), F.max(F.when(R.has(f, R.READ1), F.col("rec_id"))).alias("r1"), F.max(F.when(~R.has(f, R.READ1), F.col("rec_id"))).alias("r2")
    )
    return g.where("n = 2 and r1 is not null and r2 is not null").select("qname", "r1", "r2")


def improper(reads: DataFrame, order: list[str]) -> DataFrame:
    """qname and how often a record follows one of the same mate number that is still waiting. Records are taken in
    order; a wait ends when the other mate comes, so the state is the run of equal mates since the last pair."""
    w = Window.partitionBy("qname").orderBy(*order)
    m = R.mate(F.col("flag"))
    lag = passing(reads, supplementary=True).withColumn("m", m).withColumn("before", F.lag("m").over(w))
    run = lag.withColumn("run", F.sum(F.when(F.col("before") == F.col("m"), 0).otherwise(1)).over(w))
    # Within alternating runs of lengths c1, c2, ...: a run of c leaves c - 1 improper, and its last meets the next run.
    g = run.groupBy("qname", "run").agg(F.count("*").alias("c"))
    # Whether a run's first record finds a mate waiting: the run before had one left after meeting its own predecessor.
    seq = g.groupBy("qname").agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "c"))), lambda x: x["c"].cast("int")).alias("cs"))
    start = F.struct(F.lit(0).alias("waits"), F.lit(0).alias("n"))

    def step(a, c):
        left = c - a["waits"]
        return F.struct(F.when(left > 0, 1).otherwise(0).alias("waits"), (a["n"] + F.greatest(left - 1, F.lit(0))).alias("n"))

    return seq.select("qname", F.aggregate("cs", start, step, lambda a: a["n"]).cast("long").alias("improper")).where("improper > 0")


def zip_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records of two files by their number; first words of the names must agree, and the shorter file ends it."""
    joined = a.select("n", F.col("name").alias("name1"), F.col("rec_id").alias("r1")).join(b.select("n", F.col("name").alias("name2"), F.col("rec_id").alias("r2")), "n")
    one, two = (F.split(c, r"\s+")[0] for c in ("name1", "name2"))
    return joined.select("n", F.when(one == two, one).otherwise(F.raise_error(F.concat_ws(" ", F.lit("names differ:"), one, two))).alias("qname"), "r1", "r2")


def interleaved(records: DataFrame) -> DataFrame:
    """Records 2k and 2k + 1 of one file as pair k."""
    k = F.expr("n div 2")
    first = F.col("n") % 2 == 0
    return records.groupBy(k.alias("pair")).agg(F.max(F.when(first, F.col("rec_id"))).alias("r1"), F.max(F.when(~first, F.col("rec_id"))).alias("r2")).where("r1 is not null and r2 is not null")


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Rows numbered from 0 in order without a single-task sort: range partitions are counted, then numbered within.
    The ranges come from a sample, so the partitioned rows are kept before they are counted and numbered; both would
    otherwise draw their own. There are as many counts as partitions."""
    parts = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    inner = parts.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_c"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inner.join(F.broadcast(before.select("_p", "_b")), "_p").withColumn(name, (F.col("_b") + F.col("_k")).cast("long")).drop("_p", "_k", "_b")


def with_contigs(records: DataFrame, contigs: DataFrame) -> DataFrame:
    """records (rname) with contig_id (null for a null name) by the dictionary (contig_id, contig); a name that it lacks
    is an error. A dictionary has some thousand rows at most."""
    named = F.broadcast(contigs.select("contig_id", F.col("contig").alias("_contig")))
    lost = F.raise_error(F.concat_ws(" ", F.lit("not in the dictionary:"), "rname")).cast("int")
    joined = records.join(named, F.col("rname") == F.col("_contig"), "left")
    return joined.withColumn("contig_id", F.when(F.col("rname").isNotNull() & F.col("contig_id").isNull(), lost).otherwise(F.col("contig_id"))).drop("_contig")


def counters_with_improper(reads: DataFrame, order: list[str]) -> DataFrame:
    """counters and improper, the records that follow one of the same mate that still waits."""
    n = improper(reads, order).agg(F.coalesce(F.sum("improper"), F.lit(0)).alias("improper"))
    return counters(reads).crossJoin(n)  # a row each


def unpaired(reads: DataFrame) -> DataFrame:
    """The passing records whose name is not a pair of one of each mate, those without a name too."""
    lone = name_classes(reads).where("kind <> 'pair'").select(F.col("qname").alias("_q")).distinct()
    return passing(reads).join(lone, F.col("qname").eqNullSafe(F.col("_q")), "left_semi")


def chunk_count(chunked: DataFrame) -> DataFrame:
    """One row: n_chunks, 0 for none."""
    return chunked.agg(F.coalesce(F.max("chunk_id") + 1, F.lit(0)).alias("n_chunks"))


def chunks(pairs: DataFrame, order: list[str], size: int = CHUNK_PAIRS) -> DataFrame:
    """pairs with chunk_id: so many of them in order to each chunk."""
    return numbered(pairs, order).withColumn("chunk_id", F.expr(f"n div {size}")).drop("n")
