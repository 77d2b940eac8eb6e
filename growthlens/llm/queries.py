"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.llm import chat, pii, secrets
from growthlens.llm.alignment import align
from growthlens.llm.common import table
from growthlens.llm.sql import ORACLE
from growthlens.llm.embedding_dedup import near_duplicate_vectors
from growthlens.llm.language_id import fit_language_model, identify_languages
from growthlens.llm.minhash import near_duplicates
from growthlens.llm.mixing import mix
from growthlens.llm.nearest import nearest
from growthlens.llm.packing import pack
from growthlens.llm.prefix_trie import rebuilt_trie
from growthlens.llm.quality import fit_quality_model, score_quality
from growthlens.llm.token_counts import count_tokens


def _fold(parts: int, held: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held, F.lit(False))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~_fold(4, 2)))
    return identify_languages(docs, model, _fold(4, 2).alias("held_out"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality_model(docs, table(spark, sf_dir, "labels").where(~_fold(3, 1)))
    scores = score_quality(docs, model, _fold(3, 1).alias("held_out"))
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit("</s>[INST] ok [/INST]")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        hard.alias("text"),
    )
    records = rows.unionByName(added).select(
        F.col("conv_id").alias("record_id"),
        F.to_variant_object(F.struct("turn", "role", "text")).alias("payload"),
    )
    return chat.read_back(chat.format_chats(records)).withColumnRenamed("record_id", "conv_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan_documents(docs, secrets.BlobLedger.fresh(spark))
    listed = secrets.span_list(F.col("spans"))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed.cast("binary"), 256).alias("base_sha256"),
        listed.alias("spans"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, pii.fit_span_model(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, pii.KINDS), digest, pii.joined(F.col("spans")).alias("spans"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    q.__name__: q
    for q in (
        op1_embedding_near_dedup,
        op2_nearest_neighbours,
        op3_language_id,
        op4_quality_classifier,
        op5_chat_formatting,
        op6_token_counts,
        op7_source_mixing,
        op8_minhash_near_dedup,
        op9_packing,
        op10_secret_scan,
        op11_prefix_trie,
        op12_personal_data,
        op13_tokenizer_alignment,
        pipeline,
    )
}
