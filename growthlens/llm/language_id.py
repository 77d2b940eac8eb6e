"""Language identification by a byte convolutional network over fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthlens.llm.byte_cnn import ByteCNN, padded, segment_starts, softmax, training_windows
from growthlens.llm.common import hash_share, sampled_passages, text_slices

WINDOW = 256
# Bound of the training sample: documents per language, passages per document.
SAMPLE_DOCS = 800
PASSAGES = 3
HAS_LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    languages: list[str]
    network: ByteCNN | None


def fit_language_model(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Trains on about ``sample_docs`` documents of each non-null ``lang``, drawn by a hash of doc_id.

    The label counts cover all of ``docs``; only passages of the sample reach the driver.
    """
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    sample = (
        known.where(hash_share(3) < share)
        .where(F.col("text").rlike(HAS_LETTER))
        .select("doc_id", "lang", sampled_passages(WINDOW, PASSAGES).alias("passages"), F.xxhash64("text").alias("order"))
        .orderBy("order", "doc_id", "lang")  # copies of a text in one order, so that every run trains the same model
        .limit(2 * sample_docs * max(1, len(counts)))
        .collect()
    )
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return LanguageModel([], None)
    texts = [t for r in sample for t in r["passages"]]
    classes = np.array([languages.index(r["lang"]) for r in sample for _ in r["passages"]])
    weight = len(classes) / len(languages) / np.bincount(classes, minlength=len(languages))[classes]
    network = ByteCNN(len(languages)).fit(training_windows(texts, WINDOW), classes, weight)
    return LanguageModel(languages, network)


def identify_languages(docs: DataFrame, model: LanguageModel, *extra: Column) -> DataFrame:
    """doc_id, ``extra`` columns, lang_pred and score of every row of ``docs``; a map without shuffles.

    A text is cut into windows of ``WINDOW`` bytes from its start to its end;
    the mean of their probabilities decides.  Null texts and texts without a letter are
    ``und`` with score 0, as is everything if the model has seen no labelled
    text.  Null ids stay, repeated rows are scored each, other columns are not read.
    """
    lettered = docs.select(
        "doc_id", *extra, F.when(F.col("text").rlike(HAS_LETTER), F.col("text")).alias("text")
    )
    names = [c for c in lettered.columns if c != "text"]
    schema = T.StructType(
        [lettered.schema[c] for c in names]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, network = held.value.languages, held.value.network
        for rows, texts in text_slices(batches):
            labels = np.full(len(texts), "und", dtype=object)
            scores = np.zeros(len(texts))
            some = np.flatnonzero([bool(t) for t in texts])
            if network is not None and len(some):
                data, blocks = padded([texts[i] for i in some], WINDOW)
                votes = softmax(network.logits(network.pool(data, WINDOW, blocks)).astype(np.float64))
                mean = np.add.reduceat(votes, segment_starts(blocks), axis=0) / blocks[:, None]
                best = mean.argmax(axis=1)
                labels[some] = np.array(languages, dtype=object)[best]
                scores[some] = mean[np.arange(len(best)), best].clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in names), pa.array(labels, pa.string()), pa.array(scores)], names=schema.names
            )

    return lettered.mapInArrow(run, schema)
