"""Vectors in transit: little-endian float32 bytes with a content key."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa


def stacked(column: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """The vectors of an array column, and which of them are usable (neither null, zero nor non-finite, no null components)."""
    out: list[np.ndarray | None] = []
    for value in column:
        items = value.values
        if not value.is_valid or items is None or not len(items) or items.null_count:
            out.append(None)
            continue
        vector = np.asarray(items.to_numpy(zero_copy_only=False), dtype=np.float64)
        out.append(vector if np.isfinite(vector).all() and vector.any() else None)
    return out, np.array([v is not None for v in out], dtype=bool)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random rotation of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column: list[bytes]) -> np.ndarray:
    """Vectors (n, dim) from their bytes; all of one length."""
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
