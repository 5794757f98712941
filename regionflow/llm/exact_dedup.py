"""Exact dedup by a tree of merges of sorted digest runs, in DataFrame operations only.

Every input partition belongs to a run, whose rows it gives whole to one task; there they are sorted and combined, one row
per digest. There are as many runs as input partitions, made a power of two. In a round, partitions whose numbers differ in the round's bits alone are partners: each
keeps the part of its run that these bits of the digest assign to it, sends its partners theirs, and merges what it
gets, sorted by digest, into one run, keeping for each digest the best row and the count. A round of RADIX_BITS bits
is that many binomial steps at once, so a merge is RADIX-way; after the last one every digest stands whole in the
partition that its bits name. A digest that a third of all rows share is one row of each run and RADIX rows of a
merge: no task ever gathers a group. A digest is the SHA-256 of the normalised text, verified at every level by the
text's length and a second, independent hash, which are part of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionflow.llm.common import cut, join_groups, keep_rows

RADIX_BITS = 2
#: The bits of the smallest and of the largest number of runs.
LEAST_BITS, MOST_BITS = 2, 14
#: What the comparison of texts ignores.
IGNORED = r"[\x09-\x0D\x20]+"
KEY = ["digest", "check", "n_left"]


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of docs: its digest key, its rank among equals (best), and the partition it was read in."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.select(
            F.col(id_col).alias("id"),
            text.alias("text"),
            F.regexp_replace(text, IGNORED, "").alias("left"),
        )
        .select(
            F.struct(
                (-F.length("text")).alias("order_len"),
                F.col("id").isNull().alias("order_null"),
                F.col("id").alias("id"),
                F.monotonically_increasing_id().alias("uid"),
            ).alias("best"),
            F.xxhash64("text").alias("k_text"),
            F.unhex(F.sha2(F.col("left"), 256)).alias("digest"),
            F.xxhash64("left").alias("check"),
            F.length("left").alias("n_left"),
            F.spark_partition_id().alias("part"),
        )
    )


def run_bits(partitions: int) -> int:
    """The bits of the number of runs for so many input partitions."""
    return min(MOST_BITS, max(LEAST_BITS, (partitions - 1).bit_length()))


def merge(runs: DataFrame) -> DataFrame:
    """One row per digest of each run, the verified best row and the count of those that agree in the whole key."""
    return runs.groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def gathered(runs: DataFrame, bits: int) -> DataFrame:
    """The runs, each sorted and merged in the partition of its number."""
    return merge(runs.repartitionById(1 << bits, "run").sortWithinPartitions("run", *KEY))


def exchange(runs: DataFrame, bits: int, low: int, step: int) -> DataFrame:
    """A round: the run numbers' bits from low on, step of them, become those of the digest; partners merge."""
    mask = ((1 << step) - 1) << low
    place = F.col("run").bitwiseAND((1 << bits) - 1 - mask).bitwiseOR(F.col("check").bitwiseAND(mask).cast("int"))
    return gathered(runs.withColumn("run", place), bits)


def merged_runs(leaves: DataFrame, bits: int) -> DataFrame:
    """The leaves, a run of input partitions each, and all rounds: KEY, best, n, one row per digest."""
    run = F.col("part").bitwiseAND((1 << bits) - 1)
    runs = gathered(leaves.select(*KEY, "best", F.lit(1).cast("long").alias("n"), run.alias("run")), bits)
    for low in range(0, bits, RADIX_BITS):
        runs = exchange(runs, bits, low, min(RADIX_BITS, bits - low))
    return runs.select(*KEY, "best", "n")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, k_text, keep_id, group_size, kept, digest.

    Texts are equal when they are identical after white space (space, \\t \\n \\v \\f \\r) is deleted; null counts as
    empty, and all empty texts are one group. Of a group the row with the most code points stays, then the smallest
    id (null ids last), then one of the repeats of that row. Every row of docs has a row, repeated rows and null ids
    too; an empty table gives an empty result. Other columns of docs are not looked at.
    """
    leaves = cut(digests(docs, id_col, text_col))
    total, last = leaves.agg(F.count("*"), F.coalesce(F.max("part"), F.lit(0))).first()
    merged = merged_runs(leaves, run_bits(last + 1))
    winners = cut(merged.select(*KEY, F.col("best").alias("winner"), F.col("n").alias("group_size")))
    return join_groups(leaves, winners, KEY, "group_size", total).select(
        F.col("best.id").alias("id"),
        "k_text",
        F.col("winner.id").alias("keep_id"),
        "group_size",
        (F.col("best.uid") == F.col("winner.uid")).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_groups drops; columns unchanged."""
    groups = exact_groups(docs, id_col, text_col)
    return keep_rows(docs, groups.select(F.col("id").alias("k_id"), "k_text", "kept"), id_col, text_col)
