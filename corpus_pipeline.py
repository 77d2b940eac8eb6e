"""The corpus pipeline: documents through five operators, each stage's rows stored for the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.llm import secrets
from growthlens.llm.common import cut_lineage, table
from growthlens.llm.minhash import near_duplicates
from growthlens.llm.mixing import mix, word_count
from growthlens.llm.packing import pack
from growthlens.llm.quality import fit_quality_model, score_quality
from growthlens.session import shared_dir


def _row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name of theirs can clash with a helper column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as rows with a number that none shares, stored, so that every reader sees the same numbers."""
    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("key"), _row(docs)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more; the model learns from all labels of ``docs``.

    Null and empty texts are scored like others; repeated rows are judged alike.
    """
    model = fit_quality_model(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text", _row(docs)), model, F.col("row"))
    return scored.where(F.col("score") >= 0.5).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: that of the smallest doc_id, a null id only if there is no other.

    Rows are judged each, by a stored key of their own that stands for their id,
    so different texts under one id stay or go by their own classes, and rows
    with a null id are compared like others.  Texts without words are no
    duplicates of others; of those with equal ids and texts one stays, and with
    a null id all.
    """
    keyed = _keyed(docs)
    found = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "row.text"))
    found = found.select(F.col("doc_id").alias("of"), "class_id")
    again = (word_count(F.col("row.text")) == 0) & F.col("row.doc_id").isNotNull()
    held = keyed.select(
        "key",
        F.when(again, F.struct("row.doc_id", "row.text")).alias("again"),
        F.struct(F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("row.text"), "key").alias("place"),
    )
    members = held.join(found, F.col("key") == F.col("of"))
    label = F.when(F.col("again").isNull(), F.col("class_id")).alias("class")
    members = cut_lineage(members.select("key", "again", label, "place"))
    first = members.groupBy("class", "again").agg(F.min("place")["key"].alias("first"))
    gone = members.select("key").join(first, F.col("key") == F.col("first"), "left_anti")
    return keyed.join(gone, "key", "left_anti").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts masked; n_chars follows the new text.  Null texts stay null."""
    ledger = secrets.BlobLedger.fresh(spark)
    ledger.scan(docs)
    found = ledger.rows(secrets.RULE_VERSION).where(F.size("spans") > 0).select(F.col("blob").alias("found"), "spans")
    held = docs.select(secrets.blob_id(F.col("text")).alias("blob"), _row(docs))
    joined = held.join(found, F.col("blob") == F.col("found"), "left")
    text = secrets.masked(F.col("row.text"), F.col("spans"))
    changed = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(F.when(F.col("spans").isNotNull(), changed).otherwise(F.col("row")).alias("row")).select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each row by a stored key of its own."""
    keyed = _keyed(docs)
    taken = mix(keyed.select("row.doc_id", "row.source", "row.text", "key"), key=F.col("key"))
    emitted = keyed.join(taken.where("copies > 0").select("key", "copies"), "key")
    return emitted.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]
# The trained classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each stored as Parquet in the shared folder and read again."""
    root = f"{shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
