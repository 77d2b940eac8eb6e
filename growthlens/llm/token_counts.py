"""Token counts of whole texts by rank-synchronous array merging."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from growthlens.llm.bpe import RankMerger
from growthlens.llm.common import text_slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"
# Entries a worker remembers of each kind before it starts afresh.
CACHE_ENTRIES = 250_000
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_ANY = regex.compile(public_tokenizers.PATTERN)
# A blank behind white space that no other character follows: it may lie inside a pre-token.
_INNER_BLANK = re.compile(r"\s (?!\S)")
_COUNTERS: dict[str, TokenCounter] = {}


class TokenCounter:
    """Counts the tokens of texts; remembers counts of pre-tokens and of blank-led chunks."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.pretokens: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    @staticmethod
    def split(text: str) -> list[str]:
        return (_ASCII if text.isascii() else _ANY).findall(text)

    def _learn(self, pieces: list[list[str]]) -> None:
        new = list({x for piece in pieces for x in piece} - self.pretokens.keys())
        _, counts = self.merger.merge([x.encode("utf-8", "surrogatepass") for x in new])
        self.pretokens.update(zip(new, counts.tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, the special string as one token."""
        if max(len(self.pretokens), len(self.chunks)) > CACHE_ENTRIES:
            self.pretokens.clear()
            self.chunks.clear()
        totals = [0] * len(texts)
        whole: list[tuple[int, list[str]]] = []
        led: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            parts = text.split(SPECIAL) if SPECIAL in text else [text]
            totals[i] += len(parts) - 1
            for part in parts:
                # A blank starts a pre-token if there is no white space before it
                # or something else than white space behind it, so a text whose
                # blanks are all like that falls apart into blank-led chunks.
                if "  " in part or _INNER_BLANK.search(part):
                    whole.append((i, self.split(part)))
                elif part:
                    first, *rest = part.split(" ")
                    whole.append((i, self.split(first)))
                    led.append((i, rest))
        new = list({x for _, rest in led for x in rest} - self.chunks.keys())
        cut = [self.split(" " + x) for x in new]
        self._learn([*cut, *(pieces for _, pieces in whole)])
        of = self.pretokens.__getitem__
        self.chunks.update(zip(new, [sum(map(of, pieces)) for pieces in cut], strict=True))
        for i, pieces in whole:
            totals[i] += sum(map(of, pieces))
        of = self.chunks.__getitem__
        for i, rest in led:
            totals[i] += sum(map(of, rest))
        return totals


def count_tokens(docs: DataFrame, limit: int = 512, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``; a map without shuffles.

    Null and empty texts have no bytes and no tokens; a null doc_id stays null;
    repeated rows are counted each; other columns are not read.  Texts go
    through in slices of a few megabytes; a longer text is a slice of its own.
    """
    key = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", key),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, TokenCounter(path))
        for rows, texts in text_slices(batches):
            tokens = np.array(counter.count(texts), dtype=np.int64)
            n_bytes = np.array([len(t) if t.isascii() else len(t.encode()) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
