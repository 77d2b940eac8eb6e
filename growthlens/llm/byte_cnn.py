"""Byte-level convolutional network in numpy: multi-width filters, max pooling, softmax."""

from __future__ import annotations

import numpy as np

WIDTHS = (2, 3, 4)
MARGIN = max(WIDTHS) - 1
_ROWS = 64


class ByteCNN:
    """Filters of several widths over raw bytes, max-pooled over a window and mapped to class logits.

    A filter of width w scores the w bytes from a position on; its weights are
    a table of 256 values for each of the w places.  A window of ``length``
    bytes has ``length`` positions and reads ``MARGIN`` bytes more, so
    neighbouring windows overlap by that and no byte sequence is lost between
    them.  Bytes behind the end of a text are zero.
    """

    def __init__(self, classes: int, filters: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.filters = filters
        self.tables = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
        self.weights = rng.normal(0, 0.1, (filters * len(WIDTHS), classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)
        self._quick: list | None = None

    def fit(
        self, windows: np.ndarray, classes: np.ndarray, weight: np.ndarray, epochs: int = 6, rate: float = 0.02
    ) -> ByteCNN:
        """Adam on softmax cross entropy; ``windows`` is (n, length + MARGIN) bytes."""
        rng = np.random.default_rng(11)
        params = [*self.tables, self.weights, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step, total = 0, epochs * -(-len(windows) // _ROWS)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), _ROWS):
                rows = order[at : at + _ROWS]
                step += 1
                pace = rate * (1 - 0.9 * step / total)
                for p, g, m, v in zip(params, self._gradients(windows[rows], classes[rows], weight[rows]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self._quick = None
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        length, n, f = x.shape[1] - MARGIN, len(x), self.filters
        pooled, places = [], []
        for table in self.tables:
            response = sum(table[k][x[:, k : k + length]] for k in range(len(table)))
            place = response.argmax(axis=1)
            places.append(place)
            pooled.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0])
        features = np.concatenate(pooled, axis=1)
        slope = softmax(features @ self.weights + self.bias)
        slope[np.arange(n), y] -= 1
        slope *= (weight / n)[:, None].astype(np.float32)
        back = slope @ self.weights.T
        out = []
        for i, (table, place) in enumerate(zip(self.tables, places, strict=True)):
            share = back[:, i * f : (i + 1) * f].ravel()
            grown = np.empty_like(table)
            for k in range(len(table)):
                cell = np.take_along_axis(x, place + k, axis=1).astype(np.int64) * f + np.arange(f)
                grown[k] = np.bincount(cell.ravel(), weights=share, minlength=256 * f).reshape(256, f)
            out.append(grown)
        return [*out, features.T @ slope, slope.sum(axis=0)]

    def _prepared(self) -> list:
        """Scaled 16-bit tables: the first and second pair of bytes at once, a third byte alone."""
        if self._quick is None:
            self._quick = []
            for table in self.tables:
                scale = 32000 / max(1e-6, float(np.abs(table).max(axis=1).sum(axis=0).max()))
                whole = np.rint(table * scale).astype(np.int32)
                steps = []
                for k in range(0, len(table) - 1, 2):
                    pair = whole[k][:, None, :] + whole[k + 1][None, :, :]
                    steps.append((k, True, np.clip(pair, -32767, 32767).astype(np.int16).reshape(65536, -1)))
                if len(table) % 2:
                    steps.append((len(table) - 1, False, np.clip(whole[-1], -32767, 32767).astype(np.int16)))
                self._quick.append((1 / scale, steps))
        return self._quick

    def pool(self, data: np.ndarray, length: int, blocks: np.ndarray) -> np.ndarray:
        """Max-pooled responses (blocks, filters) of consecutive blocks of ``length`` (a power of two) positions.

        ``blocks`` has the blocks of each text: behind the last of them all
        bytes are zero, whatever text follows in ``data``.
        """
        grid = data.reshape(-1, length)
        behind = np.zeros((len(grid), MARGIN), np.uint8)
        behind[:-1] = grid[1:, :MARGIN]
        behind[np.cumsum(blocks) - 1] = 0
        out = np.empty((len(grid), self.filters * len(WIDTHS)), np.float32)
        rows = max(1, 16384 // length)
        for at in range(0, len(grid), rows):
            part = np.concatenate([grid[at : at + rows], behind[at : at + rows]], axis=1).astype(np.intp)
            pair = (part[:, :-1] << 8) | part[:, 1:]
            for i, (unit, steps) in enumerate(self._prepared()):
                total = None
                for k, paired, table in steps:
                    index = (pair if paired else part)[:, k : k + length]
                    got = table.take(index, axis=0, mode="clip")
                    total = got if total is None else np.add(total, got, out=total)
                while total.shape[1] > 1:
                    half = total.shape[1] // 2
                    total = np.maximum(total[:, :half], total[:, half:])
                out[at : at + rows, i * self.filters : (i + 1) * self.filters] = total[:, 0] * np.float32(unit)
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def padded(texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as bytes, each filled up with zeros to whole blocks of ``length``; blocks of each text (one at least)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    blocks = np.maximum(1, -(-sizes // length))
    gaps = blocks * length - sizes
    data = np.frombuffer(b"".join(x for r, g in zip(raw, gaps.tolist(), strict=True) for x in (r, bytes(g))), np.uint8)
    return data, blocks


def segment_starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def training_windows(texts: list[str], length: int) -> np.ndarray:
    """The first ``length + MARGIN`` bytes of each (sampled) passage, filled up with zeros."""
    size = length + MARGIN
    return np.frombuffer(b"".join(t.encode("utf-8", "surrogatepass")[:size].ljust(size, b"\0") for t in texts), np.uint8).reshape(-1, size)

