"""Byte convolutions in numpy: learned filters as lookup tables, pooled over cells.

A filter of width w has one weight per offset and byte value (a one-hot convolution), so a
response is a sum of w table entries.  Texts are cut into cells of ``CELL`` bytes (the last
one padded with zeros) and every filter is max-pooled per cell; classifiers combine
neighbouring cells.  For speed, tables of two neighbouring offsets are added up beforehand
into one table of byte pairs.
"""

from __future__ import annotations

import numpy as np

CELL = 256
LOT = 1 << 8    # cells whose responses are held together


def cells(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as rows of one cell each, with the ``width`` bytes after it (zeros after a
    text's end, so texts do not see their neighbours); first row of each text."""
    counts = np.array([max(1, -(-len(x) // CELL)) for x in texts], np.int64)
    ends = np.cumsum(counts)
    firsts = ends - counts
    flat = np.zeros(int(ends[-1]) * CELL + width, np.uint8)
    for x, at in zip(texts, firsts.tolist(), strict=True):
        flat[at * CELL:at * CELL + len(x)] = np.frombuffer(x, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(flat, CELL + width)[::CELL].copy()
    rows[ends - 1, CELL:] = 0
    return rows, firsts


class Filters:
    """``tables``: (width, 256, filters) weights; a narrow filter has zeros beyond its width."""

    def __init__(self, tables: np.ndarray):
        self.tables = tables.astype(np.float32)
        self.width = len(tables)
        if self.width % 2:
            raise ValueError("the width must be even")
        self._pairs = None

    @property
    def pairs(self) -> list[np.ndarray]:
        if self._pairs is None:
            t = self.tables
            self._pairs = [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(1 << 16, -1) for j in range(0, self.width, 2)]
        return self._pairs

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """(cells, CELL, filters)."""
        pair = rows[:, :-1].astype(np.uint16) * np.uint16(256) + rows[:, 1:]
        out = self.pairs[0].take(pair[:, :CELL], axis=0)
        for j, table in enumerate(self.pairs[1:], 1):
            out += table.take(pair[:, 2 * j:2 * j + CELL], axis=0)
        return out

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """(cells, filters): each filter's greatest response per cell."""
        out = np.empty((len(rows), self.tables.shape[2]), np.float32)
        for a in range(0, len(rows), LOT):
            out[a:a + LOT] = self.responses(rows[a:a + LOT]).max(axis=1)
        return out

    def pooled_at(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with the places of the maxima, for training."""
        r = self.responses(rows)
        at = r.argmax(axis=1)
        return np.take_along_axis(r, at[:, None, :], 1)[:, 0], at

    def back(self, rows: np.ndarray, at: np.ndarray, grad: np.ndarray) -> np.ndarray:
        """Gradient of the tables: each maximum's gradient goes to the bytes under the filter."""
        out = np.zeros_like(self.tables)
        cell = np.arange(len(at))[:, None]
        filters = np.broadcast_to(np.arange(at.shape[1]), at.shape)
        for j in range(self.width):
            np.add.at(out[j], (rows[cell, at + j], filters), grad)
        return out


def narrow(tables: np.ndarray, widths: list[int]) -> np.ndarray:
    """Mask that keeps the first ``widths[f]`` offsets of filter f."""
    return (np.arange(len(tables))[:, None] < np.array(widths)[None, :])[:, None, :].astype(np.float32)


class Adam:
    """Adam steps for a list of arrays, in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for a, m, v, g in zip(self.arrays, self.m, self.v, grads, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)
