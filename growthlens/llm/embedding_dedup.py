"""Near-duplicate vectors by randomly rotated binary codes with correction factors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlens.llm.common import connected_components, cut_lineage, local_roots
from growthlens.llm.vectors import matrix, rotation, rows_of, stacked, unit

THRESHOLD = 0.93
# Rows that share a bucket of code bits, on average, and rows of a block.
BUCKET_ROWS = 256
BLOCK_ROWS = 512
# Chance that a pair at the threshold shares at least one bucket.
BUCKET_RECALL = 0.9999
# Standard errors on which a pair is given up without its exact cosine.
CONFIDENCE = 4.5
ROTATIONS = 2
MAX_BITS = 20


def bucket_plan(rows: int, threshold: float) -> tuple[int, int]:
    """Bits per bucket key and number of tables for a group of ``rows`` vectors.

    A random direction separates two vectors with probability angle / pi; the
    tables are as many as give a pair at the threshold its chance.
    """
    bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(1 - BUCKET_RECALL) / math.log(1 - same))


def rotated(vectors: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors under ``count`` rotations, side by side and scaled to unit length."""
    dim = vectors.shape[1]
    return np.concatenate([vectors @ rotation(dim, k) for k in range(count)], axis=1) / math.sqrt(count)


def codes_of(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits, and the correction factor of each code: its inner product with the vector it stands for."""
    bits = turned > 0
    return bits, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def possible_links(
    bits: np.ndarray, factor: np.ndarray, other: np.ndarray, threshold: float, loss: np.ndarray | float = 0.0
) -> np.ndarray:
    """Which pairs (code, other vector) may reach ``threshold``.

    code . other / factor estimates the inner product without bias; its error
    shrinks with the code length, and a pair is given up only if the estimate
    lies CONFIDENCE standard errors below the threshold.  ``loss`` is the length of
    what the other vectors lack if they were rounded; it bounds the estimate's
    shift and is allowed in full.
    """
    length = bits.shape[1]
    signs = np.where(bits, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(length))
    estimate = (signs @ other.T.astype(np.float32) + np.float32(loss)) / factor[:, None].astype(np.float32)
    error = CONFIDENCE * np.sqrt((1 - np.minimum(factor, 1) ** 2) / factor**2 / (length - 1 or 1))
    return estimate >= (threshold - error)[:, None].astype(np.float32)


def sketches(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors rounded to a byte a component, the step of each, and the length of what rounding took."""
    step = np.abs(vectors).max(axis=1) / 127
    small = np.rint(vectors / step[:, None]).astype(np.int8)
    return small, step, np.linalg.norm(vectors - small * step[:, None], axis=1)


def _sign_bits(frame: pd.DataFrame, rows: np.ndarray, dim: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(frame["code"].iloc[rows]), np.uint8).reshape(len(rows), -1)
    return np.unpackbits(packed, axis=1, count=dim * ROTATIONS).astype(bool)


def _sides(frame: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The table of a pair of blocks, and the rows of either block."""
    table, low, high = (int(frame[c].iat[0]) for c in ("table", "low", "high"))
    return table, np.flatnonzero(frame["block"] == low), np.flatnonzero(frame["block"] == high)


def _once(frame: pd.DataFrame, table: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows that share no bucket of an earlier table; of a pair within one block, one order."""
    if frame["block"].iat[0] == frame["with"].iat[0]:
        i, j = i[i < j], j[i < j]
    if table and len(i):
        width = int(frame["key_bytes"].iat[0])
        keys = np.frombuffer(b"".join(frame["keys"]), f"<u{width}").reshape(len(frame), -1)[:, :table]
        new = np.ones(len(i), bool)
        for at in range(0, len(i), 1 << 18):
            part = slice(at, at + (1 << 18))
            new[part] = ~(keys[i[part]] == keys[j[part]]).any(axis=1)
        i, j = i[new], j[new]
    return i, j


_CODED = "vec_id long, label string, node binary, vector binary"
_LINKS = "a binary, b binary, links long"


def _coded(vectors: DataFrame) -> DataFrame:
    """vec_id, label, content key (null if the vector takes no part) and vector bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            found, _ = stacked(rows.column("embedding"))
            labels = rows.column("label").to_pylist()
            raw = [v.astype("<f8").tobytes() if v is not None and lab is not None else None for v, lab in zip(found, labels, strict=True)]
            node = [
                hashlib.blake2b(r + b"|" + str(lab).encode(), digest_size=16).digest() if r is not None else None
                for r, lab in zip(raw, labels, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("vec_id").cast(pa.int64()),
                    pa.array([None if x is None else str(x) for x in labels], pa.string()),
                    pa.array(node, pa.binary()),
                    pa.array(raw, pa.binary()),
                ],
                names=["vec_id", "label", "node", "vector"],
            )

    return vectors.select("vec_id", "embedding", "label").mapInArrow(run, _CODED)


def _keyed(nodes: DataFrame, threshold: float) -> DataFrame:
    """Nodes with what their buckets exchange, worked out once.

    That is the packed code, its correction factor, the vector rounded to bytes
    (sketch, step, loss) and the keys of all their tables, each in as few bytes
    as hold it.  group_rows is the size of their (label, length) group.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (_, rows), part in frame.groupby(["dim", "group_rows"], sort=False):
                bits, tables = bucket_plan(int(rows), threshold)
                x = unit(matrix(part["vector"].tolist()))
                per_turn = x.shape[1] // bits if bits and x.shape[1] >= bits else 1
                width = 1 if bits <= 8 else 2 if bits <= 16 else 4
                keys = np.zeros((len(part), tables), f"<u{width}")
                for t in range(tables if bits else 0):
                    turn, place = divmod(t, per_turn)
                    axes = rotation(x.shape[1], turn)[:, place * bits : (place + 1) * bits]
                    signs = x @ axes > 0
                    keys[:, t] = signs @ (1 << np.arange(signs.shape[1]))
                code, factor = codes_of(rotated(x, ROTATIONS))
                small, step, loss = sketches(x)
                yield part.assign(
                    code=[c.tobytes() for c in np.packbits(code, axis=1)],
                    factor=factor,
                    sketch=[v.tobytes() for v in small],
                    step=step,
                    loss=loss,
                    key_bytes=width,
                    keys=[k.tobytes() for k in keys],
                    tables=[list(map(int, k)) for k in keys],
                )

    return nodes.mapInPandas(
        run,
        "node binary, label string, vector binary, dim int, copies long, group_rows long, code binary, factor double,"
        " sketch binary, step double, loss double, key_bytes int, keys binary, tables array<int>",
    )


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal label and length link if their cosine in double precision is
    ``threshold`` or more.  Equal vectors of a label are one node that counts
    its copies.  Nodes meet in buckets keyed by bits of their rotated signs, in
    as many tables as BUCKET_RECALL asks for; large buckets are dealt into pairs
    of blocks.  Codes, correction factors and vectors rounded to bytes are worked
    out once and stored with the keys; only they go to the buckets.  Within two
    blocks the estimates pick the nodes that may link there, and the vectors of
    these alone follow, for the exact cosines of the pairs left open.  A pair
    counts in the first table it shares, and what leaves a block pair is one row
    per node, its links and its smallest neighbour in reach, never the pairs.

    Vectors that are null, zero, or hold nulls or non-finite components, and
    rows with a null label, link with nothing: n_links 0, component_id their own
    id, kept.  Rows with a null vec_id link with nothing and are not kept.
    Repeated rows count as copies.  An empty table gives no rows; other columns
    are not read.
    """
    coded = cut_lineage(_coded(vectors))
    taking = coded.where(F.col("node").isNotNull() & F.col("vec_id").isNotNull())
    nodes = taking.groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    content = taking.join(nodes.select(F.col("node").alias("n"), "first_id", "copies"), (F.col("node") == F.col("n")) & (F.col("vec_id") == F.col("first_id")))
    content = content.dropDuplicates(["node"]).select(
        "node", "label", "vector", (F.length("vector") / 8).cast("int").alias("dim"), "copies"
    )
    content = cut_lineage(content)
    groups = content.groupBy("label", "dim").agg(F.count("*").alias("group_rows"))
    keyed = _keyed(
        content.join(groups, ["label", "dim"]).select("node", "label", "vector", "dim", "copies", "group_rows"), threshold
    )
    keyed = cut_lineage(keyed)
    exchanged = ["node", "code", "factor", "sketch", "step", "loss", "key_bytes", "keys"]
    placed = keyed.select("label", "dim", *exchanged, F.posexplode("tables").alias("table", "key"))
    bucket = ["label", "dim", "table", "key"]
    sizes = placed.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"), F.count("*").alias("n")).where("n > 1")
    dealt = (
        placed.join(sizes.drop("n"), bucket)
        .withColumn("block", F.pmod(F.xxhash64("node", "table"), F.col("blocks")))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "with"))
        .withColumn("high", F.greatest("block", "with"))
    )
    place = [*bucket, "low", "high", "block", "with"]
    together = [*bucket, "low", "high"]

    def sift(frame: pd.DataFrame) -> pd.DataFrame:
        """The nodes of two blocks that may link there, by codes and rounded vectors."""
        table, first, second = _sides(frame)
        dim = int(frame["dim"].iat[0])
        small = np.frombuffer(b"".join(frame["sketch"].iloc[second]), np.int8).reshape(len(second), -1)
        other = small * frame["step"].to_numpy()[second, None]
        loss = frame["loss"].to_numpy()[second]
        factor = frame["factor"].to_numpy()[first]
        i, j = np.nonzero(possible_links(_sign_bits(frame, first, dim), factor, rotated(other, ROTATIONS), threshold, loss))
        i, j = _once(frame, table, first[i], second[j])
        some = np.zeros(len(frame), bool)
        some[i] = some[j] = True
        return frame.loc[some, [*place, "node"]]

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        """Links of the nodes of two blocks by exact cosines."""
        table, first, second = _sides(frame)
        x = unit(matrix(frame["vector"].tolist()))
        factor = frame["factor"].to_numpy()[first]
        i, j = np.nonzero(possible_links(_sign_bits(frame, first, x.shape[1]), factor, rotated(x[second], ROTATIONS), threshold))
        i, j = _once(frame, table, first[i], second[j])
        linked = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            linked[part] = np.einsum("nd,nd->n", x[i[part]], x[j[part]]) >= threshold
        i, j = i[linked], j[linked]
        copies = frame["copies"].to_numpy()
        links = np.bincount(i, copies[j], len(frame)) + np.bincount(j, copies[i], len(frame))
        some = np.flatnonzero(links)
        node = frame["node"].to_numpy()
        root = local_roots(len(frame), i, j)
        return pd.DataFrame({"a": node[some], "b": node[root[some]], "links": links[some].astype(np.int64)})

    sifted = dealt.select(*place, *exchanged).groupBy(*together).applyInPandas(
        sift, "label string, dim int, table int, key int, low long, high long, block long, with long, node binary"
    )
    exact = keyed.select(F.col("node").alias("n"), "vector", "copies", "code", "factor", "key_bytes", "keys")
    open_ = cut_lineage(sifted).join(exact, F.col("node") == F.col("n")).drop("n")
    found = open_.groupBy(*together).applyInPandas(compare, _LINKS)
    found = cut_lineage(found.groupBy("a", "b").agg(F.sum("links").alias("links")))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("a <> b").select("a", "b"))
    ids = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = ids.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answers = (
        ids.join(least, "root")
        .join(links.withColumnRenamed("a", "node"), "node", "left")
        .select(F.col("node").alias("n"), "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    linked = taking.join(answers, F.col("node") == F.col("n")).select("vec_id", "n_links", "component_id")
    alone = coded.where(F.col("node").isNull() | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
