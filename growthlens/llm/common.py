"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.session import shared_dir

SLICE_BYTES = 4 << 20
# Rows of a stored file at least, where the number of rows is known to be small.
FILE_ROWS = 1 << 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows with about ``limit`` bytes of text at most (one row at least); null texts are empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                rows = batch.slice(start, i - start)
                yield rows, [t or "" for t in rows.column(column).to_pylist()]
                start, held = i, 0
            held += size + 1
        if start < len(sizes):
            rows = batch.slice(start)
            yield rows, [t or "" for t in rows.column(column).to_pylist()]


def files_for(rows: int) -> int:
    """Files in which up to ``rows`` narrow rows are stored."""
    return max(1, -(-rows // FILE_ROWS))


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Later steps neither compute it again nor lose it with an executor, and plan
    with its real size: a checkpoint keeps the estimate of its plan, which the
    joins of an iteration multiply without end.  The folders are named by run
    and stay until the shared folder is cleared.

    ``rows``, if given, is the most rows ``df`` can have: its last tasks are
    drawn together, so that a small step does not leave a tiny file for each of
    them.  A file costs its executor several processes on a local disk (chmod
    and its like), which hold the executor's memory until they have begun.
    """
    if rows is not None:
        df = df.coalesce(files_for(rows))
    path = f"{shared_dir(df.sparkSession)}/llm/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    ``rows``, if given, is the most rows that the edges have in both directions.

    Each round takes the smallest root among a node's neighbours (pre-aggregated
    before the shuffle), then follows that root's own root, so stars settle in
    two rounds and chains in logarithmically many.  The rounds end when no root
    changes; every round is stored, in files for as many rows as there are nodes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.where("a <> b").distinct(), rows)
    ends = both.count()
    roots = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), ends)
    while True:
        seen = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        step = roots.join(seen, "node").select("node", "root", F.least("root", "near").alias("next"))
        above = roots.select(F.col("node").alias("next"), F.col("root").alias("above"))
        step = cut_lineage(step.join(above, "next").select("node", F.least("next", "above").alias("new"), "root"), ends)
        changed = not step.where("new <> root").isEmpty()
        roots = step.select("node", F.col("new").alias("root"))
        if not changed:
            return roots


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row connected to each of ``n`` rows by the pairs (left, right)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def sampled_passages(chars: int, passages: int) -> Column:
    """Up to ``passages`` pieces of ``chars`` characters of ``text`` from places drawn by a hash of ``doc_id``."""
    room = F.greatest(F.length("text") - chars + 1, F.lit(1))
    draws = F.sequence(F.lit(1), F.least(F.lit(passages), F.ceil(F.length("text") / chars).cast("int") + 1))
    return F.transform(
        draws, lambda j: F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id", j), room) + 1).cast("int"), F.lit(chars))
    )


def hash_share(seed: int) -> Column:
    """A number from 0 to 1 drawn by a hash of ``doc_id``."""
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
