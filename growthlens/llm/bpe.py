"""Rank-synchronous byte-pair merging over ragged numpy arrays."""

from __future__ import annotations

import json

import numpy as np

_NONE = np.iinfo(np.int32).max


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 upwards in byte order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class RankMerger:
    """Merges many byte sequences at once with the ranks of a tokenizer file.

    All sequences lie end to end in one array of symbols.  Each step finds the
    lowest-rank adjacent pair of every sequence (a segmented minimum) and
    applies it everywhere in that sequence, left to right without overlap, for
    all sequences simultaneously.  Sequences without a mergeable pair leave the
    working arrays, so the work of a step follows what is still unfinished.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.span = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.span + vocab[b] for a, b in pairs], dtype=np.int64)
        cut = len(suffix)
        joined = [a[: len(a) - cut] + b if cut and a.endswith(suffix) else a + b for a, b in pairs]
        self.merged = np.array([vocab[x] for x in joined], dtype=np.int32)
        self.rank_of_key = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.rank_of_key]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each word (words are not empty)."""
        n = len(words)
        if not n:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        last = np.cumsum(sizes) - 1
        sym[last] = self.final[raw[last]]
        seq = np.repeat(np.arange(n), sizes)
        rank = np.full(len(sym), _NONE, np.int32)
        inside = np.flatnonzero(seq[1:] == seq[:-1])
        rank[inside] = self.ranks(sym[inside], sym[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, starts)
            size = np.diff(np.r_[starts, len(sym)])
            live = low < _NONE
            if not live.all():
                keep = np.repeat(live, size)
                done.append((seq[~keep], sym[~keep]))
                sym, seq, rank = sym[keep], seq[keep], rank[keep]
                low, size = low[live], size[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            apart = np.r_[True, np.diff(hit) != 1]
            if not apart.all():  # a run of equal symbols: every other pair, from the left
                place = np.arange(len(hit))
                hit = hit[(place - np.maximum.accumulate(np.where(apart, place, 0))) % 2 == 0]
            sym[hit] = self.merged[rank[hit]]
            stale = np.zeros(len(sym), bool)
            stale[hit] = True
            stale[np.maximum(hit - 1, 0)] = True
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, seq, rank, stale = sym[keep], seq[keep], rank[keep], stale[keep]
            at = np.flatnonzero(stale)
            rank[at] = _NONE
            at = at[at < len(sym) - 1]
            at = at[seq[at] == seq[at + 1]]
            rank[at] = self.ranks(sym[at], sym[at + 1])
        seq = np.concatenate([x for x, _ in done])
        sym = np.concatenate([x for _, x in done])
        return sym[np.argsort(seq, kind="stable")], np.bincount(seq, minlength=n)
