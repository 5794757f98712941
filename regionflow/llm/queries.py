"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.llm import conversations, decontaminate, divergence, embeddings, exact_dedup, langid, licenses, packing, secrets, sentencepiece_codec, simhash, toxicity, warc
from regionflow.llm.common import remainder, shared_path, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sentencepiece_codec.encode(docs, decoded_col="decoded")
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select(
        F.col("k_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("k_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, every = F.col("secrets.base"), F.concat("secrets.base", "secrets.weak")
    order = F.create_map(*[F.lit(x) for pair in ((k, i) for i, k in enumerate(secrets.KINDS)) for x in pair])
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    by_place = F.array_sort(F.transform(every, lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("o"), x["end"].alias("end"), x["kind"].alias("kind"))))
    n = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(by_place).alias("spans"),
        F.size("secrets.links").cast("long").alias("n_links"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_from(docs, table(spark, sf_dir, "labels"), learnable=toxicity.learnable())
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train_from(docs, learnable=langid.learnable())
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_licenses, licenses (distinct SPDX names in order, comma-joined), templates (numbers, likewise)
    of the matches that no rival outdoes."""
    found = licenses.find_licenses(table(spark, sf_dir, "documents")).withColumn("matches", F.filter("matches", lambda x: ~x["outdone"]))
    names = F.array_sort(F.array_distinct(F.col("matches.spdx")))
    return found.select(
        F.col("k_id").alias("doc_id"), F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"),
        F.array_join(F.col("matches.template").cast("array<string>"), ",").alias("templates"),
    )


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the packed documents: doc_id, segment, n_tokens, block (file name), row, offset."""
    packed = packing.pack(table(spark, sf_dir, "documents"), shared_path(spark, "packed"))
    return packed.select(F.col("k_id").alias("doc_id"), "segment", "n_tokens", F.substring_index("block", "/", -1).alias("block"), "row", "offset")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return warc.read_archives(manifest, with_html=False).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(table(spark, sf_dir, "conversations"))


OP8_SQL = """
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents)
WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_token_packing": op7_token_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {
    "op2_decontaminate": decontaminate.SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_warc": warc.SQL,
    "op11_embedding_near_dedup": embeddings.SQL,
    "op12_source_divergence": divergence.SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
