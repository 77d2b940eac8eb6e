"""Approximate nearest neighbours by an adaptive scan of dimensions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlens.llm.common import cut_lineage
from growthlens.llm.vectors import matrix, rotation, rows_of, stacked, unit

# Bounds of the sample that fits the lists and the number of probes.
SAMPLE_ROWS = 16_384
SAMPLE_QUERIES = 256
LIST_ROWS = 1000
MAX_LISTS = 1024
# Rows of a block of a list, and queries of a block of those that visit it.
BLOCK_ROWS = 512
QUERY_ROWS = 1024
# Share of the sample's true neighbours that the probed lists must hold.
PROBE_RECALL = 0.98
COLUMNS = 16
# Significance of the test that gives up a candidate: larger is safer.
EPSILON = 2.1


def fit_lists(sample: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, int]:
    """Centroids of the lists (spherical k-means on the sample) and the lists to probe.

    The number of probes is what covers PROBE_RECALL of the sample's own true
    neighbours, measured against brute force within the sample.
    """
    lists = int(min(MAX_LISTS, max(8, rows // LIST_ROWS), max(1, len(sample))))
    rng = np.random.default_rng(3)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(8):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    at = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    score = sample[at] @ sample.T
    score[np.arange(len(at)), at] = -2
    truth = np.argsort(-score, axis=1)[:, : min(k, max(1, len(sample) - 1))]
    near = (sample @ centres.T).argmax(axis=1)
    order = np.argsort(-(sample[at] @ centres.T), axis=1)
    place = np.argsort(order, axis=1)
    needed = np.take_along_axis(place, near[truth], axis=1) + 1
    return centres, int(np.quantile(needed, PROBE_RECALL, method="higher"))


def adaptive_scan(
    queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, k: int, first: int = 64
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that survive the scan; unit vectors under one random rotation.

    The first candidates give each query a bound: its k-th smallest squared
    distance.  For the others the squared distance grows by a block of columns
    at a time; scaled up to all columns it is an unbiased estimate, and once
    it lies beyond the bound by more than the test allows, the pair is given up.
    ``own`` marks pairs that do not count.
    """
    n, m, dim = len(queries), len(candidates), queries.shape[1]
    head = min(m, max(first, k))
    distance = 2 - 2 * queries @ candidates[:head].T
    distance[own[:, :head]] = np.inf
    bound = np.partition(distance, k - 1, axis=1)[:, k - 1] if head >= k else np.full(n, np.inf)
    alive = np.ones((n, m), bool)
    alive[:, :head] = distance <= bound[:, None] + 1e-6
    if m > head:
        partial = np.zeros((n, m - head))
        live = ~own[:, head:]
        rows = cols = None
        for at in range(0, dim, COLUMNS):
            q, c = queries[:, at : at + COLUMNS], candidates[head:, at : at + COLUMNS]
            if rows is None:
                partial += (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * q @ c.T
            else:
                gap = q[rows] - c[cols]
                partial[rows, cols] += (gap * gap).sum(axis=1)
            seen = min(dim, at + COLUMNS)
            slack = (1 + EPSILON / math.sqrt(seen)) ** 2 if seen < dim else 1.0
            limit = bound * (seen / dim) * slack + 1e-6
            if rows is None:
                live &= partial <= limit[:, None]
                if live.mean() < 0.25:
                    rows, cols = np.nonzero(live)
            else:
                keep = partial[rows, cols] <= limit[rows]
                rows, cols = rows[keep], cols[keep]
        if rows is not None:
            live = np.zeros_like(live)
            live[rows, cols] = True
        alive[:, head:] = live
    return np.nonzero(alive & ~own)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for each row that ``is_query`` picks.

    Nearness is the cosine in double precision of the original vectors, ties to
    the smaller vec_id; rows with the query's own vec_id are no candidates.
    Only vectors of one length are compared; each length has lists of its own.
    Every row is in the list of its nearest centroid; a query visits the lists
    that the fit on a bounded sample asks for.  The rows of a list and the
    queries that visit it are both dealt into blocks, so a list with a large
    share of all rows is scanned by many tasks, none of which holds more than a
    block of either, and each returns its ``k`` best for each query.

    Vectors that are null, zero, or hold nulls or non-finite components, and
    rows with a null vec_id, take no part.  Equal vectors are candidates each.  Of
    query rows with one vec_id the one with the least vector (by its bytes) asks.
    A query visits as many lists as hold ``k`` others, all if need be, so only
    with fewer than ``k`` candidates it gets fewer; an empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            found, good = stacked(rows.column("embedding"))
            at = np.flatnonzero(good)
            raw = [found[i].astype("<f8").tobytes() for i in at]
            kept = rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id").cast(pa.int64()), kept.column("asks"), pa.array(raw, pa.binary())],
                names=["vec_id", "asks", "vector"],
            )

    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = cut_lineage(rows.mapInArrow(clean, "vec_id long, asks boolean, vector binary"))
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy((F.length("vector") / 8).cast("int").alias("dim")).count().collect()  # a row per length
    total = sum(r["count"] for r in lengths)
    if not total:
        return spark.createDataFrame([], schema)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < min(1.0, SAMPLE_ROWS / total)).orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(2 * SAMPLE_ROWS)
    drawn: dict[int, list[bytes]] = {}
    for r in sample.select("vector").collect():
        drawn.setdefault(len(r["vector"]) // 8, []).append(bytes(r["vector"]))
    # a length that the sample does not hold is one list
    fits = {r["dim"]: fit_lists(unit(matrix(drawn[r["dim"]])), r["count"], k) for r in lengths if r["dim"] in drawn}
    held = spark.sparkContext.broadcast(fits)

    def order_of(part: pd.DataFrame, dim: int) -> tuple[np.ndarray, int]:
        """The lists of a length by nearness to each vector, and how many to probe."""
        if dim not in held.value:
            return np.zeros((len(part), 1), np.int64), 1
        centres, probes = held.value[dim]
        return np.argsort(-(unit(matrix(part["vector"].tolist())) @ centres.T), axis=1, kind="stable"), probes

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby(frame["vector"].str.len() // 8):
                yield part.assign(dim=dim, list=order_of(part, dim)[0][:, 0])

    listed = cut_lineage(rows.mapInPandas(assign, "vec_id long, asks boolean, vector binary, dim int, list int"))
    sizes = listed.groupBy("dim", "list").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"), F.countDistinct("vec_id").alias("ids"))
    sizes = cut_lineage(sizes)  # a row per list: MAX_LISTS a length at most
    ids = spark.sparkContext.broadcast({(r["dim"], r["list"]): r["ids"] for r in sizes.collect()})

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                order, probes = order_of(part, dim)
                # as many lists as the fit asks for, or more until they hold k others
                seen = np.cumsum(np.array([ids.value.get((dim, x), 0) for x in range(order.shape[1])])[order], axis=1)
                needed = np.maximum(probes, (seen <= k).sum(axis=1) + 1)
                yield part[["vec_id", "vector", "dim"]].assign(visits=[o[:n].tolist() for o, n in zip(order, needed, strict=True)])

    asking = listed.where("asks").groupBy("vec_id").agg(F.min(F.struct("vector", "dim")).alias("q")).select("vec_id", "q.*")
    asking = asking.mapInPandas(visit, "vec_id long, vector binary, dim int, visits array<int>")
    asking = asking.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.col("dim").alias("q_dim"), F.explode("visits").alias("in_list"))
    asking = cut_lineage(asking)
    visited = asking.groupBy("q_dim", "in_list").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("query_blocks"))
    blocks = sizes.join(visited, (F.col("dim") == F.col("q_dim")) & (F.col("list") == F.col("in_list")))
    blocks = F.broadcast(cut_lineage(blocks.select(F.col("dim").alias("b_dim"), F.col("list").alias("b_list"), "blocks", "query_blocks")))  # MAX_LISTS a length at most

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    candidates = listed.join(blocks, (F.col("dim") == F.col("b_dim")) & (F.col("list") == F.col("b_list"))).select(
        "dim", "list", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).alias("block"), every("query_blocks").alias("query_block"), "vec_id", "vector"
    )
    queries = asking.join(blocks, (F.col("q_dim") == F.col("b_dim")) & (F.col("in_list") == F.col("b_list"))).select(
        "q_dim", "in_list", every("blocks").alias("in_block"), F.pmod(F.xxhash64("query_id", "query"), F.col("query_blocks")).alias("in_query_block"), "query_id", "query"
    )

    def scan(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(asking) or not len(block):
            return empty
        block = block.sort_values("vec_id", kind="stable")
        c = unit(matrix(block["vector"].tolist()))
        turn = rotation(c.shape[1], 29)
        ids, turned = block["vec_id"].to_numpy(), c @ turn
        out = []
        for start in range(0, len(asking), 1024):
            part = asking.iloc[start : start + 1024]
            q = unit(matrix(part["query"].tolist()))
            asks = part["query_id"].to_numpy()
            i, j = adaptive_scan(q @ turn, turned, asks[:, None] == ids[None, :], k)
            score = np.einsum("nd,nd->n", q[i], c[j])
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
            best = place < k
            out.append(pd.DataFrame({"query_id": asks[i[best]], "vec_id": ids[j[best]], "score": score[best]}))
        return pd.concat(out)

    found = (
        queries.groupBy("q_dim", "in_list", "in_block", "in_query_block")
        .cogroup(candidates.groupBy("dim", "list", "block", "query_block"))
        .applyInPandas(scan, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
