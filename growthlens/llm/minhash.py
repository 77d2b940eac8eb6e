"""MinHash near-duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlens.llm.common import connected_components, cut_lineage, files_for, local_roots, text_slices
from growthlens.llm.shingles import (
    TABLE_BITS,
    Shingles,
    jaccard,
    jaccard_matrix,
    mixed,
    numbered_shingles,
    weighted_shingles,
    word_hashes,
)

THRESHOLD = 0.8
# A pair at the threshold shares a band with probability 1 - (1 - 0.8^4)^14 = 0.9994.
BANDS, BAND_ROWS = 14, 4
SAMPLES = BANDS * BAND_ROWS
# Pairs whose samples agree less are not verified: 3.8 standard errors below the threshold.
LEAST_AGREEMENT = 0.6
# Buckets up to this size compare all their members; larger ones begin with a hub.
SMALL_BUCKET = 12
BLOCK_ROWS = 512
SLICE_BYTES = 1 << 20
_STEP = 1 << 15
_UNIFORM_BITS = 13
_EXPONENTIAL = -np.log((np.arange(1 << _UNIFORM_BITS) + 0.5) / (1 << _UNIFORM_BITS)).astype(np.float32)
_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")


def samples_of(shingles: Shingles, texts: int) -> np.ndarray:
    """(texts, SAMPLES) consistent weighted samples as 32-bit numbers; every text has a shingle.

    For each shingle and sample, r and c are Gamma(2, 1) and beta uniform, all
    drawn from the shingle's hash; t = floor(ln weight / r + beta) and
    ln a = ln c - r (t - beta + 1).  The shingle of least a, with its t, is the
    sample: two texts agree with the probability of their weighted Jaccard similarity.
    """
    out = np.empty((texts, SAMPLES), np.uint32)
    starts = np.searchsorted(shingles.text, np.arange(texts))
    ends = np.r_[starts[1:], len(shingles.text)]
    mask = np.uint64((1 << _UNIFORM_BITS) - 1)
    done = 0
    while done < texts:  # whole texts, about _STEP shingles at a time
        last = max(done + 1, int(np.searchsorted(ends, starts[done] + _STEP, side="right")))
        part = slice(starts[done], ends[last - 1])
        key, log_weight = shingles.key[part], np.log(shingles.weight[part])
        index = np.arange(len(key), dtype=np.int64)
        firsts = starts[done:last] - starts[done]
        seeds = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        for k in range(SAMPLES):
            draw = mixed(key ^ seeds[k])
            c = _EXPONENTIAL.take((draw & mask).view(np.int64))
            c += _EXPONENTIAL.take(((draw >> np.uint64(13)) & mask).view(np.int64))
            r = _EXPONENTIAL.take(((draw >> np.uint64(26)) & mask).view(np.int64))
            r += _EXPONENTIAL.take(((draw >> np.uint64(39)) & mask).view(np.int64))
            beta = (draw >> np.uint64(52)).astype(np.float32) * np.float32(1 / 4096)
            t = np.floor(log_weight / r + beta)
            value = (np.log(c) - r * (t - beta + 1)).view(np.int32)
            ordered = (value ^ ((value >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64)
            least = np.minimum.reduceat((ordered << 32) | index, firsts) & 0xFFFFFFFF
            chosen = mixed(key[least] ^ mixed(t[least].astype(np.int64).view(np.uint64) + seeds[k]))
            out[done:last, k] = (chosen >> np.uint64(32)).astype(np.uint32)
        done = last
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    key = np.zeros((len(samples), BANDS), np.uint64)
    for j in range(BAND_ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, j::BAND_ROWS][:, :BANDS].astype(np.uint64))
    return key.view(np.int64)


def content_key(text: str) -> bytes | None:
    """Digest of the lower-case words of a text; null without words."""
    words = _BLANKS.sub(" ", text.lower()).strip(" ")
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest() if words else None


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the word)) + 1 by hashed word, over all of ``docs``.

    The table has 2^TABLE_BITS entries whatever the corpus: words that share an
    entry share its count.  Each task sums its own table before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << TABLE_BITS) + 1, np.int64)  # the last entry counts documents
        for _, texts in text_slices(batches, limit=SLICE_BYTES):
            words, sizes = word_hashes(texts)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            seen = np.unique((owner << TABLE_BITS) | (words & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64))
            table += np.bincount(seen & ((1 << TABLE_BITS) - 1), minlength=len(table))
            table[-1] += len(texts)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(table[at])], names=["entry", "n"])

    rows = docs.select("text").mapInArrow(run, "entry int, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    counts = np.zeros((1 << TABLE_BITS) + 1)
    for entry, n in rows.collect():
        counts[entry] = n
    return (np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1).astype(np.float32)


def _signed(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """doc_id, content key, band keys and samples; the key is null for texts without words."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, bands array<bigint>, samples array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, limit=SLICE_BYTES):
            words, sizes = word_hashes(texts)
            some = np.flatnonzero(sizes)
            if len(some) < len(texts):
                rows = pa.concat_batches([rows.take(pa.array(some)), rows.take(pa.array(np.flatnonzero(sizes == 0)))])
            samples = samples_of(weighted_shingles(words, sizes[some], idf.value), len(some))
            node = [content_key(texts[i]) for i in some] + [None] * (len(texts) - len(some))
            empty = len(texts) - len(some)
            bands = pa.ListArray.from_arrays(
                np.r_[np.arange(len(some) + 1) * BANDS, np.full(empty, len(some) * BANDS)].astype(np.int32),
                pa.array(band_keys(samples).ravel()),
            )
            kept = pa.ListArray.from_arrays(
                np.r_[np.arange(len(some) + 1) * SAMPLES, np.full(empty, len(some) * SAMPLES)].astype(np.int32),
                pa.array(samples.view(np.int32).ravel()),
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(node, pa.binary()), bands, kept],
                names=["doc_id", "node", "bands", "samples"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of ``nodes`` (node, first_id); a text whose id is shared by another is told apart by its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            good = [content_key(t) == n for t, n in zip(texts, rows.column("node").to_pylist(), strict=True)]
            yield rows.filter(pa.array(good, pa.bool_()))

    found = docs.select("doc_id", "text").join(nodes.select("node", "first_id"), F.col("doc_id") == F.col("first_id"))
    return found.select("node", "text").mapInArrow(run, "node binary, text string")


def _verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is ``threshold`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, left in text_slices(batches, "text_a", SLICE_BYTES):
            right = rows.column("text_b").to_pylist()
            one = weighted_shingles(*word_hashes(left), idf.value)
            two = weighted_shingles(*word_hashes(right), idf.value)
            good = jaccard(one, two, len(left)) >= threshold
            yield rows.select(["a", "b"]).filter(pa.array(good))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) with the share of samples they agree in, LEAST_AGREEMENT or more."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = nodes.select(F.col("node").alias("a"), F.col("samples").alias("x"))
    two = nodes.select(F.col("node").alias("b"), F.col("samples").alias("y"))
    same = F.aggregate(
        F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda acc, v: acc + v
    ) / F.lit(float(SAMPLES))
    return pairs.join(one, "a").join(two, "b").select("a", "b", same.alias("same")).where(F.col("same") >= LEAST_AGREEMENT)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are not in one component yet."""
    one = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    two = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def _cross_links(
    large: DataFrame, rows: int, texts: DataFrame, roots: DataFrame, idf: Broadcast, threshold: float
) -> DataFrame:
    """Links within large buckets between nodes that are not in one component yet.

    ``large`` is (band, key, hub, node) of ``rows`` rows.  A bucket's members outside its hub's
    component are dealt against all its members in blocks, and the weighted
    Jaccard similarities of two blocks come from one product of matrices.  Pairs
    inside the hub's component need no comparison, so a group of copies around
    its hub costs nothing here.  A block pair returns a row per linked node.
    """
    root = roots.select(F.col("node").alias("of"), "root")
    member = large.join(root, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node")).drop("of")
    member = member.join(root.withColumnRenamed("root", "hub_root"), F.col("hub") == F.col("of"), "left").drop("of")
    member = member.withColumn("out", F.col("root") != F.coalesce("hub_root", "hub")).drop("hub_root", "hub")
    member = cut_lineage(member.repartition(files_for(rows)))
    sizes = member.groupBy("band", "key").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"), F.ceil(F.count_if("out") / BLOCK_ROWS).alias("outer")
    )
    dealt = member.join(sizes.where("outer > 0"), ["band", "key"]).join(texts, "node")
    spread = F.xxhash64("node", "band")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    task = ["band", "key", "block", "outer"]
    right = dealt.withColumn("block", F.pmod(spread, F.col("blocks"))).withColumn("outer", all_of("outer"))
    left = dealt.where("out").withColumn("outer", F.pmod(spread, F.col("outer"))).withColumn("block", all_of("blocks"))
    left = left.select(*[F.col(c).alias(f"o_{c}") for c in (*task, "node", "root", "text")])

    def compare(outer: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(outer) or not len(block):
            return pd.DataFrame({"a": [], "b": []})
        one = numbered_shingles(*word_hashes(outer["o_text"].tolist()), idf.value)
        two = numbered_shingles(*word_hashes(block["text"].tolist()), idf.value)
        linked = jaccard_matrix(one, two, len(outer), len(block)) >= threshold
        linked &= outer["o_root"].to_numpy()[:, None] != block["root"].to_numpy()[None, :]
        i, j = np.nonzero(linked)
        node = np.r_[outer["o_node"].to_numpy(), block["node"].to_numpy()]
        tied = local_roots(len(node), i, j + len(outer))
        some = np.unique(np.r_[i, j + len(outer)])
        return pd.DataFrame({"a": node[some], "b": node[tied[some]]})

    found = left.groupBy(*[f"o_{c}" for c in task]).cogroup(right.select(*task, "node", "root", "text").groupBy(*task))
    return found.applyInPandas(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, exact_id, class_id and kept for every row of ``docs`` (doc_id, text).

    Texts are compared by shingles of five lower-case words, weighted by term
    frequency times the mean inverse document frequency of their words (a
    shingle's own document frequency would fall with the size of its group of
    copies and tear large groups apart).  Texts link at a weighted Jaccard
    similarity of ``threshold`` or more; classes are the connected texts, and
    class_id is the smallest doc_id of a class; the row that has it is kept.

    Texts of equal words collapse to one node (exact_id is its smallest
    doc_id).  Nodes that share a band meet: all pairs in small buckets; in
    larger ones each with the bucket's hub, which differs by band, and
    afterwards, in blocks, what the hubs left unconnected.  Pairs whose samples
    agree enough are verified on the texts, each node's best first; later rounds
    skip pairs that are already connected.

    Null texts and texts without words are classes of their own (class_id their
    id, kept).  A row with a null id is matched by equal words only and always
    kept.  Rows with equal ids are answered each.  An empty table gives no
    rows; other columns are not read.
    """
    idf = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(docs))
    signed = cut_lineage(_signed(docs, idf))
    worded = signed.where(F.col("node").isNotNull())
    nodes = cut_lineage(
        worded.groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("samples").alias("samples")
        ),
        signed.count(),
    )
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node"))["node"].alias("hub")
    )
    met = cut_lineage(banded.join(buckets.where("n > 1"), ["band", "key"]), BANDS * nodes.count())
    few = F.col("n") <= SMALL_BUCKET
    in_small, in_large = met.agg(F.coalesce(F.sum(F.when(few, F.col("n") - 1)), F.lit(0)), F.count_if(~few)).first()
    small = met.where(few).groupBy("band", "key").agg(F.array_sort(F.collect_list("node")).alias("m"))
    small = small.select("m", F.posexplode("m").alias("i", "a")).select(
        "a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b")
    )
    large = met.where(~few)
    hubs = large.select(F.col("node").alias("a"), F.col("hub").alias("b"))
    pairs = cut_lineage(_agreeing(small.unionByName(hubs), nodes).repartition(files_for(in_small // 2 + in_large)))
    most = pairs.count()

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(large.select("node")).distinct()
    texts = cut_lineage(_texts_of(docs, nodes.join(wanted, "node")))
    ends = pairs.select("same", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
    best = ends.groupBy("p.a").agg(F.max(F.struct("same", "p.b"))["b"].alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut_lineage(_verified(best, texts, idf, threshold).repartition(files_for(most)))
    roots = connected_components(links, 2 * most)
    rest = _apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), roots)
    links = cut_lineage(links.unionByName(_verified(rest, texts, idf, threshold)).repartition(files_for(most)))
    roots = connected_components(links, 2 * most)
    if in_large:
        cross = _cross_links(large.select("band", "key", "hub", "node"), in_large, texts, roots, idf, threshold)
        links = links.unionByName(cross.where("a <> b"))
        roots = connected_components(links)

    classes = nodes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("class_id"))
    answers = classes.join(least, "root").select(F.col("node").alias("n"), F.col("first_id").alias("exact_id"), "class_id")
    found = worded.join(answers, F.col("node") == F.col("n")).select("doc_id", "exact_id", "class_id")
    alone = signed.where(F.col("node").isNull()).select(
        "doc_id", F.col("doc_id").alias("exact_id"), F.col("doc_id").alias("class_id")
    )
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
