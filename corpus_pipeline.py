"""A training-data pipeline over documents: each stage calls one of the operators on what its predecessor kept.

Toxic documents go, then exact copies, then near copies (one document of each group stays), then documents that hold
benchmark passages; what is left is encoded. run() chains the stages; the driver writes each stage's result as Parquet
and reads it again as the next one's docs. Every stage handles nulls, repeated rows, empty tables and extra columns as
its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.llm import decontaminate, exact_dedup, sentencepiece_codec, simhash, toxicity
from regionflow.llm.common import shared_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those scored THRESHOLD or more. The model learns from the labelled documents of the whole table. Null
    and empty texts stay unless the model finds a text without letters toxic, repeated rows stay or go together; with no
    labels of one kind all texts have the share of toxic labels as their score."""
    model = toxicity.train_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learnable=toxicity.learnable())
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return toxicity.score(whole, model).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each group of exact copies, as exact_dedup.exact_groups picks it: null and empty texts are one
    group, of repeated rows one stays, an empty table stays empty, further columns come along whatever their names."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with the row of the smallest id of each component, as simhash.near_groups builds them: texts without words are
    one component, of repeated rows one stays, an empty table stays empty, further columns come along."""
    return simhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that decontaminate.contamination finds contaminated: null and empty texts stay, repeated rows
    stay or go together, an empty benchmark or an empty table removes nothing, further columns come along."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


#: Chunks that a worker of the last stage keeps: fewer than alone, since the stages before it have filled the executor.
REMEMBERED = 50_000


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and whether the ids give the text back (a text's own U+2581 comes back as a space)."""
    out = sentencepiece_codec.encode(docs.select("doc_id", "text", F.col("text").alias("original")), decoded_col="decoded", remembered=REMEMBERED)
    same = F.col("decoded") == F.replace(F.coalesce("original", F.lit("")), F.lit("▁"), F.lit(" "))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode),
]
#: The scores of the first stage and the ids of the last have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
