"""Quality classifier: a byte convolutional network over overlapping chunks of whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthlens.llm.byte_cnn import ByteCNN, padded, segment_starts, training_windows
from growthlens.llm.common import hash_share, sampled_passages, text_slices

# A chunk spans two blocks and begins at every block, so chunks overlap by half.
BLOCK = 256
# Bound of the training sample: documents per class, passages per document.
SAMPLE_DOCS = 2500
PASSAGES = 4
SHORT = 60
_LIMIT = 10.0


@dataclass
class QualityModel:
    """``slope`` and ``shift`` map the mean chunk logit of a document to its log odds."""

    network: ByteCNN | None
    slope: float
    shift: float

    def document_logits(self, texts: list[str]) -> np.ndarray:
        """Mean logit of the chunks of each whole text."""
        data, blocks = padded(texts, BLOCK)
        pooled = self.network.pool(data, BLOCK, blocks)
        starts = segment_starts(blocks)
        chunks = np.maximum(pooled, np.r_[pooled[1:], pooled[-1:]])
        last = starts + blocks - 1
        chunks[last] = pooled[last]
        used = np.ones(len(chunks), bool)
        used[last[blocks > 1]] = False  # the last block is part of the chunk before
        logits = self.network.logits(chunks).astype(np.float64)
        odds = np.where(used, np.clip(logits[:, 1] - logits[:, 0], -_LIMIT, _LIMIT), 0.0)
        return np.add.reduceat(odds, starts) / np.add.reduceat(used.astype(np.float64), starts)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.document_logits(texts) + self.shift)))


def fit_quality_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> QualityModel:
    """Trains on about ``sample_docs`` labelled documents of each class, drawn by a hash of doc_id.

    ``labels`` has doc_id and quality (0 or 1; others are left out).  Class
    counts cover all labels and weigh the sample, so odds follow the whole
    table.  The sampled labels are the bounded side of a broadcast join, and one
    text of each sampled id (the first by hash) is trained on.  With a
    class missing the model scores every text with the share of class 1 (1 if
    there are no labels at all).
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        odds = _LIMIT if counts.get(1) or not counts else -_LIMIT
        return QualityModel(None, 0.0, odds)
    share = F.when(F.col("quality") == 1, min(1.0, sample_docs / counts[1])).otherwise(min(1.0, sample_docs / counts[0]))
    drawn = known.where(hash_share(9) < share).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(4 * sample_docs)
    drawn = drawn.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = (
        docs.select("doc_id", "text")
        .where(F.length("text") > 0)
        .join(F.broadcast(drawn), "doc_id")
        .select(
            "doc_id",
            "quality",
            sampled_passages(2 * BLOCK, PASSAGES).alias("passages"),
            F.element_at(sampled_passages(SHORT, 1), 1).alias("short"),
            F.xxhash64("text").alias("order"),
        )
        .groupBy("doc_id")  # one text of an id, so that the rows are bounded as the labels are
        .agg(F.min(F.struct("order", "quality", "passages", "short")).alias("first"))
        .select("doc_id", "first.*")
        .orderBy("order", "doc_id")  # copies of a text in one order, so that every run trains the same model
        .collect()
    )
    owner = np.repeat(np.arange(len(sample)), [len(r["passages"]) for r in sample])
    quality = np.array([r["quality"] for r in sample], dtype=np.int64)
    seen = np.bincount(quality, minlength=2)
    if not seen.all():
        return QualityModel(None, 0.0, _LIMIT if seen[1] or not seen.any() else -_LIMIT)
    windows = training_windows([t for r in sample for t in r["passages"]], 2 * BLOCK)
    of_class = np.array([counts[0], counts[1]]) / seen
    weight = (of_class / of_class[quality].mean())[quality]
    # one short passage of each document, so that short texts are not taken for poor ones
    short = training_windows([r["short"] for r in sample], 2 * BLOCK)
    network = ByteCNN(2).fit(
        np.r_[windows, short],
        np.r_[quality[owner], quality],
        np.r_[weight[owner] / np.bincount(owner)[owner] * PASSAGES, weight],
    )
    flat = np.ascontiguousarray(windows[:, : 2 * BLOCK]).ravel()
    logits = network.logits(network.pool(flat, 2 * BLOCK, np.ones(len(windows), np.int64))).astype(np.float64)
    odds = np.bincount(owner, np.clip(logits[:, 1] - logits[:, 0], -_LIMIT, _LIMIT)) / np.bincount(owner)
    slope, shift = _calibrated(odds, quality, weight)
    return QualityModel(network, slope, shift)


def _calibrated(odds: np.ndarray, quality: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the mean logit, by Newton steps with a small ridge."""
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - quality)) + 1e-2 * (w - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(curve, slope)
    return float(w[0]), float(w[1])


def score_quality(docs: DataFrame, model: QualityModel, *extra: Column) -> DataFrame:
    """doc_id, ``extra`` columns and score of every row of ``docs``; a map without shuffles.

    Every block of a text is part of a chunk, so the whole document counts.
    Null and empty texts are one chunk of zero bytes; null ids stay, repeated
    rows are scored each, other columns are not read.
    """
    wanted = docs.select("doc_id", *extra, "text")
    names = [c for c in wanted.columns if c != "text"]
    schema = T.StructType([wanted.schema[c] for c in names] + [T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for rows, texts in text_slices(batches):
            if model.network is None:
                scores = np.full(len(texts), 1 / (1 + np.exp(-model.shift)))
            else:
                scores = model.scores(texts)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(scores)], names=schema.names)

    return wanted.mapInArrow(run, schema)
