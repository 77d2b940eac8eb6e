"""Packing of documents into token sequences by first-fit decreasing."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from growthlens.llm.bpe import RankMerger
from growthlens.llm.common import cut_lineage, text_slices

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
LENGTH = 4096
# Documents of a randomised group: bounds the memory of one packing call.
GROUP_DOCS = 4096
# Pre-tokens a worker remembers before it starts afresh.
CACHE_ENTRIES = 400_000
_WORDS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
# Plain characters: visible ASCII, the letters of Latin-1 and ASCII white space.
_PLAIN_TEXT = re.compile(r"[ \t\n\r\x0b\x0c!-~À-ÿ]*")
_PRETOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of whole texts, as the tokenizers library gives them for the same file.

    The pre-tokenizer drops white space, so a text's ids are those of its
    pre-tokens in order.  Each distinct pre-token's ids are worked out once, by
    merging arrays of pre-tokens, and remembered in one flat array.  Chunks
    with anything but plain characters (special strings, other scripts, control
    characters) are encoded by the library as they are.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.merger = RankMerger(path)
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def split(text: str) -> list[str]:
        """Pre-tokens in lower case; a chunk for the library is led by a blank."""
        if _PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            return _PRETOKENS.findall(text.lower())
        out: list[str] = []
        for chunk in _WORDS.findall(text):
            plain = _PLAIN_TEXT.fullmatch(chunk) and "<|" not in chunk
            out += _PRETOKENS.findall(chunk.lower()) if plain else [" " + chunk]
        return out

    def _learn(self, new: list[str]) -> None:
        plain = [x for x in new if x[0] != " "]
        other = [x for x in new if x[0] == " "]
        ids, sizes = self.merger.merge([x.encode() for x in plain])
        more = [self.library.encode(x[1:], add_special_tokens=False).ids for x in other]
        sizes = np.r_[sizes, np.fromiter(map(len, more), np.int64, len(more))]
        self.slots.update(zip([*plain, *other], range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32), *(np.array(x, np.uint32) for x in more)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.slots) > CACHE_ENTRIES:
            self.clear()
        words = [self.split(t) for t in texts]
        if new := list({w for ws in words for w in ws} - self.slots.keys()):
            self._learn(new)
        out = []
        for ws in words:
            slot = np.array(list(map(self.slots.__getitem__, ws)), np.int64)
            size = self.sizes[slot]
            shift = np.repeat(self.starts[slot] - (np.cumsum(size) - size), size)
            out.append(self.ids[shift + np.arange(len(shift))])
        return out


def pieces_of(ids: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, unsigned CRC-32 of the little-endian ids) of the pieces of one document."""
    ids = ids.astype("<u4")
    for start in range(0, len(ids), length):
        part = ids[start : start + length]
        yield start, len(part), zlib.crc32(part.tobytes())


def first_fit_decreasing(sizes: list[int], length: int) -> list[tuple[int, int]]:
    """(bin, offset) of each size, the sizes being in descending order.

    A tournament tree holds the free capacity of every bin, its inner nodes the
    larger of their children: walking down to the left whenever the left child
    can take the size finds the first bin that fits in logarithmic time.
    """
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [length] * (2 * leaves)
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        out.append((node - leaves, length - tree[node]))
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return out


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    path: str = VOCABULARY,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
    seed: int = 7,
) -> DataFrame:
    """Pieces of all documents of ``docs``, packed into sequences of at most ``length`` tokens.

    A document's tokens (its ids and ``end_id``) are cut every ``length``; full
    pieces are sequences of their own (negative ids), the remainders are packed
    by first-fit decreasing within groups of about ``group_docs`` documents,
    dealt by a seeded hash of id, text and a stored row number.  Only numbers are
    shuffled, never texts, and no group grows with the input, whatever repeats.

    Null and empty texts are one token; null ids are kept; repeated rows are
    packed each; an empty table gives no pieces; other columns are not read.
    """
    key = docs.schema["doc_id"].dataType
    cut = T.StructType(
        [
            T.StructField("doc_id", key),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("text_crc32", T.LongType()),
        ]
    )

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, WordEncoder(path))
        for rows, texts in text_slices(batches):
            take, columns = [], []
            for i, (text, ids) in enumerate(zip(texts, encoder.encode(texts), strict=True)):
                ids = np.r_[ids, np.uint32(end_id)]
                crc = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                for start, size, ids_crc in pieces_of(ids, length):
                    take.append(i)
                    columns.append((start, size, ids_crc, len(ids), crc))
            numbers = np.array(columns, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(take, pa.int64())), *(pa.array(c) for c in numbers.T)],
                names=cut.names,
            )

    n_groups = max(1, math.ceil(docs.count() / group_docs))
    pieces = docs.select("doc_id", "text").mapInArrow(tokens, cut)
    pieces = cut_lineage(pieces.withColumn("at", F.monotonically_increasing_id()))  # equal rows go to different groups by it
    columns = [F.col(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    whole = pieces.where(F.col("length") == length).select(
        *columns, (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    group = F.pmod(F.xxhash64("doc_id", "text_crc32", "at", F.lit(seed)), F.lit(n_groups))
    rest = pieces.where(F.col("length") < length).select(*columns, group.alias("group"))
    packed = T.StructType([*cut.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "doc_id", "ids_crc32", "start"], ascending=[False, True, True, True], kind="stable"
        )
        placed = np.array(first_fit_decreasing(frame["length"].tolist(), length), dtype=np.int64).reshape(-1, 2)
        # bins of a group are fewer than its pieces; interleaving keeps ids unique over groups
        frame["sequence_id"] = placed[:, 0] * n_groups + frame["group"]
        frame["offset"] = placed[:, 1]
        return frame[packed.names]

    return whole.unionByName(rest.groupBy("group").applyInPandas(fit, packed))
