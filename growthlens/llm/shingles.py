"""Word shingles of whole texts as numpy arrays, weighted by term and document frequency."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORDS = 5
TABLE_BITS = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, up to ``n``."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, base in enumerate((_BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts in order, and the number of words of each text.

    Words are runs of anything but ASCII white space.  A prefix sum of the
    bytes times powers of an odd base gives every word's polynomial hash at once.
    """
    raw = [t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    words = mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    return words, np.diff(np.searchsorted(start, np.r_[0, ends]))


@dataclass
class Shingles:
    """Distinct shingles of several texts: the text's number, the shingle's hash, its weight; in that order."""

    text: np.ndarray
    key: np.ndarray
    weight: np.ndarray


def _occurrences(words: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> Shingles:
    """Every occurrence of a shingle of five words, with the mean inverse document frequency of its words.

    Sorted by text and shingle.  A text of fewer words is one shingle; a text
    without words has none.
    """
    n = len(words)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(n) - starts[owner]
    count = np.minimum(sizes, WORDS)[owner]
    at = np.flatnonzero(place <= np.maximum(sizes - WORDS, 0)[owner])
    key = np.zeros(len(at), np.uint64)
    weight = np.zeros(len(at), np.float64)
    word_idf = idf[(words & np.uint64(len(idf) - 1)).astype(np.int64)]
    for k in range(WORDS):
        has = count[at] > k
        w = words[np.minimum(at + k, n - 1)]
        key = np.where(has, mixed(key * _BASE + w + np.uint64(k)), key)
        weight += np.where(has, word_idf[np.minimum(at + k, n - 1)], 0)
    weight /= count[at]
    order = np.lexsort((key, owner[at]))
    return Shingles(owner[at][order], key[order], weight[order].astype(np.float32))


def _first_of_runs(s: Shingles) -> np.ndarray:
    if not len(s.key):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.r_[True, (s.text[1:] != s.text[:-1]) | (s.key[1:] != s.key[:-1])])


def weighted_shingles(words: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> Shingles:
    """Distinct shingles of each text; weight is term frequency times inverse document frequency."""
    every = _occurrences(words, sizes, idf)
    new = _first_of_runs(every)
    times = np.diff(np.r_[new, len(every.key)]).astype(np.float32)
    return Shingles(every.text[new], every.key[new], every.weight[new] * times)


def numbered_shingles(words: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> Shingles:
    """All occurrences, the n-th of a shingle in a text being an item of its own.

    Over such items a weighted Jaccard similarity is that of plain sets with
    item weights, for the minimum of two term frequencies counts the numbers both reach.
    """
    every = _occurrences(words, sizes, idf)
    new = _first_of_runs(every)
    times = np.diff(np.r_[new, len(every.key)])
    number = np.arange(len(every.key)) - np.repeat(new, times)
    return Shingles(every.text, mixed(every.key + number.astype(np.uint64) * _BASE), every.weight)


def jaccard_matrix(a: Shingles, b: Shingles, rows: int, columns: int, step: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarity of every text of ``a`` with every text of ``b``, from numbered shingles."""
    common = np.intersect1d(a.key, b.key)
    shared = np.zeros((rows, columns))
    if len(common):
        one, two = ((np.minimum(np.searchsorted(common, s.key), len(common) - 1), s) for s in (a, b))
        one, two = ((at, s, common[at] == s.key) for at, s in (one, two))
        for start in range(0, len(common), step):
            parts = []
            for (at, s, hit), n in ((one, rows), (two, columns)):
                use = hit & (at >= start) & (at < start + step)
                part = np.zeros((n, min(step, len(common) - start)), np.float32)
                part[s.text[use], at[use] - start] = s.weight[use] if not parts else 1
                parts.append(part)
            shared += parts[0] @ parts[1].T
    total = np.bincount(a.text, a.weight, rows)[:, None] + np.bincount(b.text, b.weight, columns)[None, :]
    return shared / np.maximum(total - shared, 1e-12)


def jaccard(a: Shingles, b: Shingles, pairs: int) -> np.ndarray:
    """Weighted Jaccard similarity of text i of ``a`` and text i of ``b``: sum of minima over sum of maxima."""
    text = np.r_[a.text, b.text]
    key = np.r_[a.key, b.key]
    weight = np.r_[a.weight, b.weight].astype(np.float64)
    order = np.lexsort((key, text))
    text, key, weight = text[order], key[order], weight[order]
    same = np.flatnonzero((text[1:] == text[:-1]) & (key[1:] == key[:-1]))
    low = np.bincount(text[same], np.minimum(weight[same], weight[same + 1]), pairs)
    total = np.bincount(text, weight, pairs)
    return np.where(total > low, low / np.maximum(total - low, 1e-12), (total > 0).astype(float))
