"""Cross-tokenizer alignment by coalescing the byte intervals of two tokenizers' tokens."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthlens.llm.bpe import byte_chars
from growthlens.llm.common import cut_lineage, text_slices

VOCABULARY_A = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY_B = public_tokenizers.path("piece_bpe_32k.model")
# Text of a slice: its documents share one dictionary of linked id pairs.
SLICE_BYTES = 1 << 20
# An id pair is one long: the id of A times this, plus the id of B.
PAIR_SPAN = 1 << 31
# White space (as Unicode defines it) too long for the pre-token pattern's look-ahead.
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{500,}")
_DIGEST = "doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ENCODERS: dict[tuple[str, str], TokenizerPair] = {}


class TokenizerPair:
    """Token ids of whole texts by both tokenizers, and each id's bytes; special strings are ordinary text."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            vocabulary = json.load(f)
        special = {t["content"] for t in vocabulary.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        entries = {x: i for x, i in vocabulary["model"]["vocab"].items() if x not in special}
        ranks = {bytes(byte_of[c] for c in x): i for x, i in entries.items()}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.bytes_a[i] = raw
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # the ids as text in front of each separator: none, and those inside a side, between sides and between groups
        self.texts = [
            np.array([str(i) + end for i in range(max(len(self.bytes_a), len(self.bytes_b)))], dtype=object) for end in ("", ",", "|", ";")
        ]

    def ids_a(self, text: str) -> list[int]:
        """Ids of ``text`` by A.

        Of a long run of white space all but its last character (or all, at the
        end) is one pre-token, which goes to the merging without the pattern.
        """
        out: list[int] = []
        done = 0
        for run in _LONG_BLANK.finditer(text):
            cut = run.end() - (run.end() < len(text))
            out += self.a.encode_ordinary(text[done : run.start()]) + self.a._encode_single_piece(text[run.start() : cut])
            done = cut
        return out + self.a.encode_ordinary(text[done:])

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of ``" " + text`` by A and of ``text`` by B; none where the bytes of either side are not the text's."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = (" " + text).encode()
            a = self.ids_a(" " + text) if text else []
            same = text and b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw
            out.append((a, b) if same else ([], []))
        return out


@dataclass
class Aligned:
    """The alignment of a slice of documents: numbers by document, groups as text, and links by document."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    link_doc: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def coalesced(pair: TokenizerPair, encoded: list[tuple[list[int], list[int]]]) -> Aligned:
    """Aligns all documents of a slice at once.

    The tokens of both sides lie on one line of bytes, document after document,
    sorted by start.  The running maximum of their ends closes a group wherever
    the next start reaches it.  Inside, each distinct start begins the overlap
    of the last token of A and the last of B that have begun.
    """
    docs = len(encoded)
    n_a = np.fromiter((len(a) for a, _ in encoded), np.int64, docs)
    n_b = np.fromiter((len(b) for _, b in encoded), np.int64, docs)
    ids_a = np.fromiter((i for a, _ in encoded for i in a), np.int64, n_a.sum())
    ids_b = np.fromiter((i for _, b in encoded for i in b), np.int64, n_b.sum())
    size_a, size_b = pair.size_a[ids_a], pair.size_b[ids_b]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)  # both sides of a document have the same bytes
    start = np.concatenate([end_a - size_a, end_b - size_b])
    end = np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
    order = np.lexsort((side, start))
    start, end, side = start[order], end[order], side[order]
    if not len(start):
        zero = np.zeros(docs, np.int64)
        none = np.empty(0, np.int64)
        return Aligned(n_a, n_b, zero, zero, [""] * docs, none, none, none)
    reach = np.maximum.accumulate(end)
    opens = np.r_[True, start[1:] >= reach[:-1]]
    group = np.cumsum(opens) - 1
    begun_a, begun_b = np.cumsum(side == 0), np.cumsum(side == 1)
    last = np.r_[start[1:] != start[:-1], True]  # the last token at a distinct start
    at_a, at_b = begun_a[last] - 1, begun_b[last] - 1
    doc_a = np.repeat(np.arange(docs), n_a)
    # the groups as text: A's tokens stand behind those of B in earlier groups, B's behind all of A so far
    group_a, group_b = group[side == 0], group[side == 1]
    firsts = np.flatnonzero(opens)
    count = np.diff(np.r_[firsts, len(group)])
    count_a = np.bincount(group_a, minlength=len(firsts))
    before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count - count_a) - (count - count_a)
    place_a = np.arange(len(ids_a)) + before_b[group_a]
    place_b = np.arange(len(ids_b)) + (before_a + count_a)[group_b]
    ids = np.empty(len(start), np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark = np.ones(len(start), np.int8)
    mark[place_a[np.r_[group_a[1:] != group_a[:-1], True]]] = 2
    mark[place_b[np.r_[group_b[1:] != group_b[:-1], True]]] = 3
    both = np.cumsum(n_a + n_b)
    mark[both[(n_a + n_b) > 0] - 1] = 0
    words = np.empty(len(start), object)
    for k, texts in enumerate(pair.texts):
        words[mark == k] = texts[ids[mark == k]]
    words = words.tolist()
    groups = ["".join(words[x:y]) for x, y in zip(np.r_[0, both[:-1]].tolist(), both.tolist(), strict=True)]
    of_group = doc_a[before_a]  # every group has a token of A
    link_doc = doc_a[at_a]
    return Aligned(
        n_a, n_b, np.bincount(of_group, minlength=docs), np.bincount(link_doc, minlength=docs), groups, link_doc, ids_a[at_a], ids_b[at_b]
    )


def _pair(path_a: str, path_b: str) -> TokenizerPair:
    return _ENCODERS.get((path_a, path_b)) or _ENCODERS.setdefault((path_a, path_b), TokenizerPair(path_a, path_b))


def aligned_groups(docs: DataFrame, path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B) -> DataFrame:
    """doc_id and ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of A and B by group) of every row; a map without shuffles.

    The rules for odd rows are those of ``align``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        for rows, texts in text_slices(batches, limit=SLICE_BYTES):
            groups = coalesced(pair, pair.encode(texts)).groups
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(groups, pa.string())], names=["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, groups string")


def _encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds: a document's numbers and links, and the id pairs of its slice.

    A slice has one row with its distinct ``pairs`` and in how many of its
    documents each is linked (``held``); a document's ``links`` are places in
    that row and their repeats.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"{_DIGEST.format(key=key)}, slice long, links binary, pairs array<bigint>, held array<bigint>"
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        context = TaskContext.get()
        number = context.partitionId() << 32 if context else 0
        for rows, texts in text_slices(batches, limit=SLICE_BYTES):
            got = coalesced(pair, pair.encode(texts))
            pairs, place = np.unique(got.link_a * PAIR_SPAN + got.link_b, return_inverse=True)
            found, repeats = np.unique(got.link_doc * max(1, len(pairs)) + place, return_counts=True)
            doc, place = np.divmod(found, max(1, len(pairs)))
            held = np.bincount(place, minlength=len(pairs))
            cuts = np.searchsorted(doc, np.arange(1, len(texts)))
            links = [
                np.stack([p, r]).astype("<i4").tobytes() for p, r in zip(np.split(place, cuts), np.split(repeats, cuts), strict=True)
            ]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got.groups]
            n, none = len(texts), [None]
            arrays = [
                pa.concat_arrays([rows.column("doc_id").cast(rows.schema.field("doc_id").type), pa.nulls(1, rows.schema.field("doc_id").type)]),
                *(pa.array(x.tolist() + none, pa.int64()) for x in (got.n_a, got.n_b, got.n_groups, got.n_links)),
                pa.array(digests + none, pa.string()),
                pa.array([number] * (n + 1), pa.int64()),
                pa.array(links + none, pa.binary()),
                pa.array([None] * n + [pairs.astype(np.int64)], pa.list_(pa.int64())),
                pa.array([None] * n + [held.astype(np.int64)], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            number += 1

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def linked_pairs(slices: DataFrame) -> DataFrame:
    """pair, count (documents that hold it linked) and best (the highest count of its id of A) over all slices."""
    counts = cut_lineage(slices.groupBy("pair").agg(F.sum("held").alias("count")))
    highest = counts.groupBy(_id_a(F.col("pair")).alias("id_a")).agg(F.max("count").alias("highest"))
    joined = counts.withColumn("id", _id_a(F.col("pair"))).join(highest, F.col("id") == F.col("id_a"))
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _id_a(pair: Column) -> Column:
    return F.shiftright(pair, 31)


def align(docs: DataFrame, path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B) -> DataFrame:
    """The alignment of two tokenizers over every row of ``docs``, with corpus-wide counts of the linked id pairs.

    doc_id, n_a, n_b (tokens), n_groups, n_links (overlapping token pairs),
    n_best (links whose pair has the highest count of its id of A, ties
    included), count_sum (the counts of all links) and groups_sha256.

    Texts are encoded and aligned once, slice by slice.  What is shuffled are
    the distinct id pairs of each slice, never texts, tokens or links: they are
    summed up to the counts, and each slice gets its own pairs' counts back.  A
    pair has one row a slice at most, so frequent pairs do not weigh more.

    Null and empty texts, and texts that either tokenizer does not give back
    byte by byte, have no tokens: zeros and an empty digest.  Null ids are
    kept; repeated rows count as documents each; an empty table gives no rows;
    other columns are not read.  A very long text is a slice of its own.
    """
    stored = cut_lineage(_encoded(docs, path_a, path_b))
    slices = stored.where(F.col("pairs").isNotNull()).select("slice", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "of"))
    slices = slices.select("slice", "place", F.col("of.pairs").alias("pair"), F.col("of.held").alias("held"))
    counted = linked_pairs(slices.select("pair", "held")).withColumnRenamed("pair", "counted")
    answers = slices.join(counted, F.col("pair") == F.col("counted")).select(F.col("slice").alias("in_slice"), "place", "count", "best")
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def total(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        count, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        place = pairs.column("place").to_numpy()
        count[place] = pairs.column("count").to_numpy()
        best[place] = pairs.column("best").to_numpy().astype(np.int64)
        sums, bests = [], []
        for raw in rows.column("links").to_pylist():
            at, repeats = np.frombuffer(raw, "<i4").reshape(2, -1).astype(np.int64)
            sums.append(int(count[at] @ repeats))
            bests.append(int(best[at] @ repeats))
        columns = {c: rows.column(c) for c in names if c not in ("n_best", "count_sum")}
        columns |= {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table({c: columns[c] for c in names})

    documents = stored.where(F.col("pairs").isNull()).drop("pairs", "held")
    return documents.groupBy("slice").cogroup(answers.groupBy("in_slice")).applyInArrow(total, schema)
